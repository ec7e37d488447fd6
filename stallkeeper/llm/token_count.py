"""Token counts of whole texts by a sentencepiece model, with overlap resynchronisation.

A text longer than ``chunk`` characters is encoded in overlapping chunks.  Token offsets follow from the
lengths of the pieces.  Two neighbours are spliced at a place in their overlap where both have a token
boundary and which is proven stable: no piece of the vocabulary holds those two characters side by side,
so no merge can cross it.  If the overlap has no such place it is doubled, up to the whole chunk,
and chunks that cannot be split are encoded as one.

Null text is empty and has no tokens.  Each row is counted by itself, so ties, repeated rows and
null ids need no rule.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

_MODELS: dict[str, "PieceModel"] = {}


class PieceModel:
    def __init__(self, path: str):
        import sentencepiece

        self.sp = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.sp.id_to_piece(i) for i in range(self.sp.get_piece_size())]
        #: characters of a piece in UTF-8 bytes of the text; a blank is written as U+2581
        self.width = np.array([1 if self.sp.is_byte(i) else len(p.replace("▁", " ").encode())
                               for i, p in enumerate(pieces)], np.int64)
        self.joined = {p[k:k + 2] for i, p in enumerate(pieces) if not self.sp.is_byte(i) for k in range(len(p) - 1)}
        #: the model keeps blanks and characters as they are; else offsets don't follow from lengths
        self.exact = all(self.sp.decode(self.sp.encode(t)) == t for t in ("  a  b ", "éﬁＡ Å", "x\t\ny"))

    def whole(self, text: str) -> list[int]:
        return self.sp.encode(text, num_threads=1)

    def stable(self, text: str, at: int) -> bool:
        """No piece can hold the characters on both sides of ``at``."""
        return text[at - 1:at + 1].replace(" ", "▁") not in self.joined

    def _starts(self, text: str, ids: list[int]) -> dict[int, int]:
        """Character offset to token number of the token starts; inner bytes of a character that has no piece are left out."""
        at = np.cumsum(self.width[ids]) - self.width[ids] - 1  # the model puts a blank in front
        size = np.frombuffer(text.encode("utf-32-le"), "<u4")
        ends = np.cumsum(1 + (size > 0x7F).astype(np.int64) + (size > 0x7FF) + (size > 0xFFFF))
        chars = np.searchsorted(ends, np.maximum(at, 0), side="right")
        begin = np.where(chars > 0, ends[np.maximum(chars - 1, 0)], 0)
        good = (begin == at) & (at > 0)
        return dict(zip(chars[good].tolist(), np.flatnonzero(good).tolist(), strict=True))

    def ids(self, text: str, chunk: int, overlap: int) -> list[int]:
        if len(text) <= chunk or not self.exact:
            return self.whole(text)
        text = text.replace("▁", " ")  # the model takes both for a blank
        out: list[int] = []
        start, skip, end = 0, 0, chunk
        cur = self.whole(text[:end])
        while end < len(text):
            reach, nxt = overlap, min(len(text), end + chunk)
            while True:
                low = max(start, end - reach)
                if low == start:  # nothing to splice at: the two become one chunk
                    cur = self.whole(text[start:nxt])
                    break
                right = self.whole(text[low:nxt])
                a, b = self._starts(text[start:end], cur), self._starts(text[low:nxt], right)
                lost = end - low  # common places, the last first, that are proven stable
                place = next((p for p in sorted(b, reverse=True) if 0 < p < lost and p + low - start in a
                              and a[p + low - start] >= skip and self.stable(text, p + low)), None)
                if place is not None:
                    out += cur[skip:a[place + low - start]]
                    start, skip, cur = low, b[place], right
                    break
                reach *= 2
            end = nxt
        return out + cur[skip:]


def model(path: str) -> PieceModel:
    if path not in _MODELS:
        _MODELS[path] = PieceModel(path)
    return _MODELS[path]


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, chunk: int = 20_000, overlap: int = 500) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of whole texts."""

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model(model_path)
        for batch in batches:
            texts = batch.column(1).to_pylist()
            n = np.fromiter((len(m.ids(t, chunk, overlap)) for t in texts), np.int64, len(texts))
            size = np.fromiter((len(t.encode()) for t in texts), np.int64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(size), pa.array(n)], ["doc_id", "n_bytes", "n_tokens"])

    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = slim.mapInArrow(count, "doc_id long, n_bytes long, n_tokens long")
    return counted.withColumn("over_limit", F.col("n_tokens") > limit)
