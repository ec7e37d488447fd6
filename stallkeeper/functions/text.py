"""Text analysis as SQL expressions over one text column (no Python rows).

As in ``strings``, builders map SQL text to SQL text and ``v1``/``v2`` name the
two published behaviours.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from .strings import drop, lit

# A word is a run of letters, digits and underscores of any script.  The plain
# range first lets the matcher skip the Unicode lookup for most characters.
WORD = r"[a-z0-9_\p{L}\p{N}]+"

# Word lists of the published text functions.
POSITIVE_V1 = """good great excellent amazing wonderful fantastic awesome perfect love like best brilliant
outstanding superb magnificent terrific marvelous happy pleased satisfied delighted thrilled""".split()
NEGATIVE_V1 = """bad terrible awful horrible disgusting hate dislike worst pathetic useless disappointing
frustrated angry sad upset annoyed furious poor inferior defective broken failed""".split()
NEGATION_V1 = "not no never nothing nowhere nobody none neither nor cannot cant wont dont".split()
POSITIVE_V2 = "good great excellent amazing love best wonderful fantastic happy satisfied perfect".split()
NEGATIVE_V2 = "bad terrible awful hate worst horrible disappointed poor broken useless waste".split()
KEYWORD_STOP_V1 = """the a an and or but in on at to for of with by from up about into through during before after
above below is are was were be been being have has had do does did will would could should may might must can this
that these those i you he she it we they""".split()
KEYWORD_STOP_V2 = """the a an and or but in on at to for of with by is are was were be been have has had do does did
will would could should may might this that these those it its i you he she we they not no from as into""".split()
COUNT_STOP_V1 = "the a an and or but in on at to for of with by from is are was were".split()
COUNT_STOP_V2 = "the a an and or but in on at to for of with by is are was".split()
HTML_ENTITIES = [("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'")]
TEXT_PHONE = r"(\+?\d{1,3})?[\s.-]?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}"
SCRIPTS = {
    "latin": "a-zA-Z",
    "chinese": r"\x{4e00}-\x{9fff}",
    "japanese": r"\x{3040}-\x{30ff}",
    "korean": r"\x{ac00}-\x{d7af}",
    "arabic": r"\x{0600}-\x{06ff}",
}


def in_list(x: str, words: list[str]) -> str:
    return f"{x} in ({', '.join(repr(w) for w in words)})"


def tokens(c: str) -> str:
    return f"regexp_extract_all(lower({c}), {lit(WORD)}, 0)"


def _by_score(score: str) -> str:
    return f"case when {score} > 0 then 'positive' when {score} < 0 then 'negative' else 'neutral' end"


def sentiment_v1(c: str) -> str:
    """Every hit counts; a negation word flips the next word and is never scored."""
    polarity = f"case when {in_list('w', POSITIVE_V1)} then 1 when {in_list('w', NEGATIVE_V1)} then -1 else 0 end"
    step = (f"(acc, w) -> if({in_list('w', NEGATION_V1)}, named_struct('score', acc.score, 'flip', true), "
            f"named_struct('score', acc.score + if(acc.flip, -({polarity}), {polarity}), 'flip', false))")
    score = f"aggregate({tokens(c)}, named_struct('score', 0, 'flip', false), {step}, acc -> acc.score)"
    return f"coalesce(transform(array({score}), s -> {_by_score('s')})[0], 'neutral')"


def sentiment_v2(c: str) -> str:
    """Distinct words, no negation."""
    hits = lambda words: f"size(filter(ws, w -> {in_list('w', words)}))"
    return (f"coalesce(transform(array(array_distinct({tokens(c)})), "
            f"ws -> {_by_score(hits(POSITIVE_V2) + ' - ' + hits(NEGATIVE_V2))})[0], 'neutral')")


def keyword_tokens(c: str, variant: str) -> str:
    """Candidate words of a text, in order, with repeats."""
    if variant == "v1":
        return f"filter({tokens(c)}, w -> length(w) > 2 and not {in_list('w', KEYWORD_STOP_V1)})"
    return f"filter({tokens(c)}, w -> w rlike '^[a-z]{{3,}}$' and not {in_list('w', KEYWORD_STOP_V2)})"


def _let(value: str, name: str, body: str) -> str:
    """``body`` with ``name`` standing for ``value``, computed once."""
    return f"transform(array({value}), {name} -> {body})[0]"


def _runs(words: str, first: str, fields: str) -> str:
    """One struct for each run of equal words in the sorted array ``ps``; ``first`` is the word of an entry."""
    word = lambda k: first.format(f"get(ps, {k})")
    starts = f"if(size(ps) = 0, array(), filter(sequence(0, size(ps) - 1), k -> k = 0 or {word('k')} <> {word('k - 1')}))"
    n = "cast(coalesce(get(st, k + 1), size(ps)) - p as bigint)"
    runs = f"transform(st, (p, k) -> named_struct('w', {word('p')}, 'n', {n}{fields}))"
    return _let(words, "ps", _let(starts, "st", runs))


def word_counts(arr: str) -> str:
    """array<(w, n)>, sorted: each word with its count, from one sort of the plain words instead of a pass per word."""
    return _runs(f"sort_array({arr})", "{0}", "")


def placed_word_counts(arr: str) -> str:
    """array<(w, n, i)>: ``word_counts`` with the first place of each word."""
    return _runs(f"sort_array(transform({arr}, (w, i) -> named_struct('w', w, 'i', i)))", "{0}.w", ", 'i', get(ps, p).i")


def keywords(c: str, variant: str, top: str = "5") -> str:
    """Per-row top words, ties by first appearance (corpus jobs use a shuffle)."""
    weight = " * length(x.w)" if variant == "v1" else ""
    ranked = f"sort_array(transform({placed_word_counts(keyword_tokens(c, variant))}, x -> named_struct('s', -x.n{weight}, 'i', x.i, 'w', x.w)))"
    # an integer array built from an empty text stays empty, so '' comes out
    return f"coalesce(array_join(transform(slice({ranked}, 1, int({top})), k -> k.w), ','), '')"


def similarity_v1(a: str, b: str) -> str:
    """Shared words over all words; 0 when a text is missing or has no words."""
    pair = f"named_struct('a', array_distinct({tokens(a)}), 'b', array_distinct({tokens(b)}))"
    either = "double(size(p.a) + size(p.b) - n)"
    shared = _let("size(array_intersect(p.a, p.b))", "n", f"try_divide(double(n), {either})")
    return f"coalesce({_let(pair, 'p', f'if(p.a is null or p.b is null, null, {shared})')}, 0.0D)"


def count_norm(arr: str) -> str:
    """Sum of the squared counts of a ``word_counts``."""
    return f"aggregate({arr}, 0L, (s, x) -> s + x.n * x.n)"


def count_dot(a: str, b: str) -> str:
    """Sum over shared words of the product of their counts."""
    # in the joined sorted counts a shared word stands next to itself
    dot = ("aggregate(if(size(m) < 2, array(), sequence(0, size(m) - 2)), 0L, "
           "(s, k) -> s + if(m[k].w = m[k + 1].w, m[k].n * m[k + 1].n, 0L))")
    return _let(f"sort_array(concat({a}, {b}))", "m", dot)


def similarity_v2(a: str, b: str) -> str:
    """Cosine of word counts, four decimals."""
    body = f"round(try_divide(double({count_dot('p.a', 'p.b')}), sqrt(double({count_norm('p.a')})) * sqrt(double({count_norm('p.b')}))), 4)"
    pair = f"named_struct('a', {word_counts(tokens(a))}, 'b', {word_counts(tokens(b))})"
    return f"coalesce({_let(pair, 'p', body)}, 0.0D)"


def word_count(c: str, variant: str) -> str:
    if variant == "v1":
        keep = f"length(w) > 2 and not {in_list('w', COUNT_STOP_V1)}"
    else:
        keep = f"not {in_list('w', COUNT_STOP_V2)}"
    return f"coalesce(cast(size(filter({tokens(c)}, w -> {keep})) as bigint), 0L)"


def _has(c: str, script: str) -> str:
    return f"{c} rlike {lit('[' + SCRIPTS[script] + ']')}"


def language_v1(c: str) -> str:
    """Share of characters per script: latin above 0.7, others above 0.3."""
    n = lambda script: f"length({drop(c, '[^' + SCRIPTS[script] + ']')})"
    over = lambda script, tenths: f"{n(script)} * 10 > length({c}) * {tenths}"
    return (f"case when {c} is null or {c} = '' then 'unknown' when {over('latin', 7)} then 'english' "
            + " ".join(f"when {over(s, 3)} then '{s}'" for s in ("chinese", "japanese", "korean", "arabic"))
            + " else 'unknown' end")


def language_v2(c: str) -> str:
    """First script found decides."""
    return (f"case when {c} is null then 'unknown' when {_has(c, 'chinese')} then 'zh' "
            f"when {_has(c, 'japanese')} then 'ja' when {_has(c, 'korean')} then 'ko' else 'en' end")


def _squeeze(c: str) -> str:
    return drop(drop(c, r"(?U)\s+", " "), r"^ | \z")


_TAGS, _MAIL_V1, _URL = "<[^>]+>", r"(?U)\S+@\S+", r"https?://[!$-_a-z]+"
_MARKS = r"(?U)[^\p{L}\p{N}_\s]"
_MAIL_V2, _PHONE_V2 = r"(?U)\S+@\S+\.\S+", r"(?U)\b[\d\-\(\)\+\s]{7,}\b"


def _entities(c: str) -> str:
    for code, char in HTML_ENTITIES:
        char = char.replace("'", "\\'")
        c = f"replace({c}, '{code}', '{char}')"
    return c


def _clean_all_v1(c: str) -> str:
    for pattern in (_TAGS, _MAIL_V1, TEXT_PHONE, _URL, _MARKS):
        c = drop(c, pattern)
    return _squeeze(c)


def _clean_v2(c: str, tags: bool, mail: bool, phone: bool) -> str:
    if tags:
        c = drop(c, _TAGS, " ")
    if mail:
        c = drop(c, _MAIL_V2)
    if phone:
        c = drop(c, _PHONE_V2)
    return _squeeze(c)


CLEAN_MODES = {
    "v1": {
        "html": lambda c: _entities(drop(c, _TAGS)),
        "email": lambda c: drop(c, _MAIL_V1),
        "phone": lambda c: drop(c, TEXT_PHONE),
        "url": lambda c: drop(c, _URL),
        "punctuation": lambda c: drop(c, _MARKS),
        "numbers": lambda c: drop(c, r"\p{Nd}+"),
        "whitespace": _squeeze,
        "all": _clean_all_v1,
    },
    "v2": {
        "html": lambda c: _clean_v2(c, True, False, False),
        "email": lambda c: _clean_v2(c, False, True, False),
        "phone": lambda c: _clean_v2(c, False, False, True),
        "all": lambda c: _clean_v2(c, True, True, True),
    },
}


def clean_text(c: str, mode: str, variant: str = "v1") -> str:
    return CLEAN_MODES[variant][mode](c)


def col(sql: str) -> Column:
    return F.expr(sql)
