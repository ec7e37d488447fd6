"""Checks for the text and string jobs."""

from __future__ import annotations

from stallkeeper.sources.adapters import ctes

# Word lists of the published text functions, stated here so that the checks don't take them from the code under test.
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

_TEXT = ctes("shop_text")
# Word, address and number patterns.
_TOK = r"regexp_extract_all(lower({0}),'[\p{{L}}\p{{N}}_]+')"
_MAIL = r"'[A-Za-z0-9+_.-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}'"
_PHONE = r"'(\+?\d{1,3})?[-.\s]?\(?\d{3}\)?[-.\s]?\d{3}[-.\s]?\d{4}'"


def _list(words: list[str]) -> str:
    return "(" + ",".join(f"'{w}'" for w in words) + ")"


def _tok(c: str = "text") -> str:
    return _TOK.format(c)


_WORDS = _TEXT + f""", tk as (select doc_id, lang, {_tok()} ws from shop_text),
    wd as (select doc_id, unnest(ws) w, unnest(range(len(ws))) i from tk) """
_LABEL = "case when coalesce(sc,0)>0 then 'positive' when coalesce(sc,0)<0 then 'negative' else 'neutral' end"
_S1 = _WORDS + f""", sg as (select doc_id, case when w in {_list(NEGATION_V1)} then 0 else
      (case when w in {_list(POSITIVE_V1)} then 1 when w in {_list(NEGATIVE_V1)} then -1 else 0 end)
      * case when lag(w) over (partition by doc_id order by i) in {_list(NEGATION_V1)} then -1 else 1 end end s from wd),
    ss as (select doc_id, sum(s) sc from sg group by 1), lb as (select d.doc_id, d.lang, {_LABEL} sentiment from shop_text d left join ss using (doc_id)) """
_S2 = _WORDS + f""", ss as (select doc_id, count(distinct w) filter (where w in {_list(POSITIVE_V2)}) - count(distinct w) filter (where w in {_list(NEGATIVE_V2)}) sc
    from wd group by 1), lb as (select d.doc_id, d.lang, {_LABEL} sentiment from shop_text d left join ss using (doc_id)) """


def _keywords(keep: str, score: str, k: int) -> str:
    return f""", kw as (select doc_id, w, count(*) f, min(i) p from wd where {keep} group by 1,2),
    rk as (select *, row_number() over (partition by doc_id order by {score} desc, p) k from kw),
    ks as (select doc_id, string_agg(w, ',' order by k) keywords from rk where k<={k} group by 1) """


_K1 = _keywords(f"length(w)>2 and w not in {_list(KEYWORD_STOP_V1)}", "f*length(w)", 5)
_K2 = _keywords(f"regexp_full_match(w,'[a-z]{{3,}}') and w not in {_list(KEYWORD_STOP_V2)}", "f", 3)


def _count(c: str, cls: str) -> str:
    return f"length(regexp_replace({c},'[^{cls}]','','g'))"


_CJK = r"\x{4e00}-\x{9fff}"
_L1 = f"""case when text is null or text='' then 'unknown' when {_count('text', 'a-zA-Z')}::double/length(text)>0.7 then 'english'
    when {_count('text', _CJK)}::double/length(text)>0.3 then 'chinese' when {_count('text', r'\x{3040}-\x{30ff}')}::double/length(text)>0.3 then 'japanese'
    when {_count('text', r'\x{ac00}-\x{d7af}')}::double/length(text)>0.3 then 'korean' when {_count('text', r'\x{0600}-\x{06ff}')}::double/length(text)>0.3 then 'arabic'
    else 'unknown' end"""
_L2 = r"""case when text is null then 'unknown' when regexp_matches(text,'[\x{4e00}-\x{9fff}]') then 'zh'
    when regexp_matches(text,'[\x{3040}-\x{30ff}]') then 'ja' when regexp_matches(text,'[\x{ac00}-\x{d7af}]') then 'ko' else 'en' end"""


def _sub(c: str, pattern: str, by: str = "") -> str:
    return f"regexp_replace({c},'{pattern}','{by}','g')"


def _sq(c: str) -> str:
    return f"trim({_sub(c, chr(92) + 's+', ' ')})"


_TAG, _AT, _TEL, _URL, _PUNCT = "<[^>]+>", r"\S+@\S+", r"(\+?\d{1,3})?[\s.-]?\(?\d{3}\)?[\s.-]?\d{3}[\s.-]?\d{4}", r"https?://[!$-_a-z]+", r"[^\p{L}\p{N}_\s]"
_HTML1 = _sub("text", _TAG)
for _code, _char in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''")):
    _HTML1 = f"replace({_HTML1},'{_code}','{_char}')"
_CLEAN1 = {
    "html": _HTML1, "email": _sub("text", _AT), "phone": _sub("text", _TEL), "url": _sub("text", _URL), "punctuation": _sub("text", _PUNCT),
    "numbers": _sub("text", r"\p{Nd}+"), "whitespace": _sq("text"),
    "all": _sq(_sub(_sub(_sub(_sub(_sub("text", _TAG), _AT), _TEL), _URL), _PUNCT)),
}
_HTML2 = _sq(_sub("text", _TAG, " "))
# \b knows only ASCII letters in this engine: spell the accented ones out and back
_ACCENTS = {x: f"Qq{chr(97 + i)}qQ" for i, x in enumerate("ÄÇÈÉÊÍÑÓÖÜßäçèéêíñóöü")}


def _chain(c: str, pairs: list[tuple[str, str]]) -> str:
    for old, new in pairs:
        c = f"replace({c},'{old}','{new}')"
    return c


_MAILLESS = _sub(_sub("text", _TAG, " "), r"\S+@\S+\.\S+")
_ALL2 = _sq(_chain(_sub(_chain(_MAILLESS, list(_ACCENTS.items())), r"\b[\d\-\(\)\+\s]{7,}\b"), [(v, k) for k, v in _ACCENTS.items()]))


def _clean(expr: str) -> str:
    return _TEXT + f"""select doc_id, source, c<>text as changed, length(c) chars, md5(c) digest from (select *, {expr} c from shop_text)"""


# whole-string helpers of the string modes
def _jtrim(c: str) -> str:
    return _sub(c, r"^[\x00-\x20]+|[\x00-\x20]+$")


def _split(c: str) -> str:
    return f"regexp_split_to_array({_jtrim(c)},'\\s+')"


def _title1(c: str) -> str:
    p = r"'(?s)^(\P{L}*)(\p{L}?)(.*)$'"
    w = f"regexp_extract(w,{p},1)||upper(regexp_extract(w,{p},2))||lower(regexp_extract(w,{p},3))"
    return f"nullif(array_to_string(list_transform({_split(c)}, lambda w: {w}),' '),'')"


def _title2(c: str) -> str:
    return f"array_to_string(list_transform({_split(c)}, lambda w: upper(left(w,1))||lower(substr(w,2))),' ')"


def _initials(c: str) -> str:
    return f"array_to_string(list_transform({_split(c)}, lambda w: upper(left(w,1))),'')"


def _slug1(c: str) -> str:
    return _sub(_sub(_sub(_sub(f"lower({c})", r"[^a-z0-9\s-]"), r"\s+", "-"), "-+", "-"), "^-|-$")


def _slug2(c: str) -> str:
    return _sub(_jtrim(_sub(f"lower({c})", r"[^a-z0-9\s-]")), r"\s+", "-")


def _stars(s: str) -> str:
    return f"if(length({s})<=2, repeat('*',length({s})), left({s},1)||repeat('*',length({s})-2)||right({s},1))"


def _is_mail(c: str) -> str:
    return f"regexp_full_match({c},{_MAIL})"


def _mask1(c: str) -> str:
    d = f"split_part({c},'@',2)"
    return (f"case when {_is_mail(c)} then {_stars(f"split_part({c},'@',1)")}||'@'||{_stars(f"split_part({d},'.',1)")}||'.'||split_part({d},'.',2) else {c} end")


def _mask2(c: str) -> str:
    l, d = f"split_part({c},'@',1)", f"split_part({c},'@',2)"
    name = f"regexp_extract({d},'^(.*)(\\.[^.]*)$',1)"
    return (f"case when {_is_mail(c)} then left({l},1)||repeat('*',greatest(length({l})-2,0))||if(length({l})>1,right({l},1),'')||'@'||"
            f"left({name},1)||repeat('*',length({name})-1)||regexp_extract({d},'^(.*)(\\.[^.]*)$',2) else {c} end")


def _mask_tel(c: str) -> str:
    dg = _sub(c, "[^0-9]")
    return f"case when regexp_matches({c},{_PHONE}) then repeat('*',length({dg})-4)||right({dg},4) else {c} end"


def _in_text(c: str, pattern: str, mask) -> str:
    """Text between the matches, and the matches masked, in turns."""
    zipped = f"list_zip(regexp_split_to_array({c},{pattern}), list_append(regexp_extract_all({c},{pattern}),''))"
    return f"array_to_string(list_transform({zipped}, lambda z: z[1]||if(z[2]='','',{mask('z[2]')})),'')"


_MASKED = f""", m1 as (select doc_id, text, {_in_text('text', _MAIL, _mask1)} c1 from shop_text),
    m2 as (select doc_id, text, {_in_text('c1', _PHONE[:-1] + "[0-9]*'", _mask_tel)} c from m1) """


def _names(title: str, plain: str, slug: str) -> str:
    return ctes("shop_products") + f"select product_id, {title} name_title, {plain} name_plain, {slug} name_slug, {_initials('product_name')} name_initials from shop_products"


_N = "product_name"
_PLAIN = _sub(_N, r"[^a-zA-Z0-9\s]")
_DC = ctes("dirty_customers")


def _pii(mail: str, tel: str) -> str:
    return _DC + f""", m as (select customer_id, country, email, phone, {mail} masked_email, {tel} masked_phone from dirty_customers),
        pm as (select customer_id, country, masked_email, masked_phone, coalesce(masked_email<>email,false) email_masked,
        coalesce(masked_phone<>phone,false) phone_masked from m) """


def _shape(v1: bool) -> str:
    num = _sub("text", "[^0-9]")
    cols = f"""doc_id, {f"nullif({num},'')" if v1 else num} extract_numbers, md5(reverse(text)) as reverse,
        {f"len({_split('text')})::varchar" if v1 else f"if({_jtrim('text')}='',0,len({_split('text')}))::varchar"} word_count"""
    if v1:
        cols += f""", md5({_sub('text', '[^a-zA-Z]')}) extract_letters, md5(upper(replace(text,'ß','SS'))) as upper, md5(lower(text)) as lower, length(text)::varchar char_count"""
    return _TEXT + f"select {cols} from shop_text"


def _utils(v2: bool) -> str:
    title = _title2 if v2 else _title1
    unknown = title("country") if v2 else "country"
    num = _sub("city", "[^0-9]")
    return _DC + f"""select customer_id, email, country, {title("('  '||first_name||'   jr. '||city)")} title, {title('country')} by_default, {unknown} unknown_mode,
        {(_mask2 if v2 else _mask1)('email')} masked, {(_slug2 if v2 else _slug1)('country')} slug, {num if v2 else f"nullif({num},'')"} digits from dirty_customers"""


_WC1 = f"len(list_filter({_tok()}, lambda w: length(w)>2 and w not in {_list(COUNT_STOP_V1)}))"
_WC2 = f"len(list_filter({_tok()}, lambda w: w not in {_list(COUNT_STOP_V2)}))"
_PAIRS = ", pr as (select doc_id doc_a, doc_id+1 doc_b from documents) "


def _functions(v2: bool) -> str:
    head = (_S2 + _K2) if v2 else (_S1 + _K1)
    if v2:
        cos = """, c1 as (select doc_id, w, count(*) n from wd group by 1,2), c2 as (select doc_id, w, count(*) n from (select doc_id, unnest(""" + _tok("text||' '||source") + """) w from shop_text) group by 1,2),
            sm as (select x.doc_id, round(sum(x.n*y.n)::double/(sqrt((select sum(n*n) from c1 where doc_id=x.doc_id)::double)*sqrt((select sum(n*n) from c2 where doc_id=x.doc_id)::double)),4) s
            from c1 x join c2 y on x.doc_id=y.doc_id and x.w=y.w group by 1) """
    else:
        cos = f""", q as (select doc_id, list_distinct({_tok()}) a, list_distinct({_tok("text||' '||source")}) b from shop_text),
            sm as (select doc_id, len(list_intersect(a,b))::double/nullif(len(list_distinct(list_concat(a,b))),0) s from q) """
    return head + cos + f"""select d.doc_id, sentiment, coalesce(keywords,'') keywords, coalesce(s,0) self_similarity, {_WC2 if v2 else _WC1} words,
        {_L2 if v2 else _L1} as language, md5({_HTML2 if v2 else _HTML1}) cleaned
        from shop_text d join lb using (doc_id) left join ks using (doc_id) left join sm using (doc_id)"""


def oracles() -> dict[str, str]:
    join = f"""with w as (select doc_id, list_distinct({_tok()}) ws from documents), g as (select list_sort(ws) k, min(doc_id) rep, count(*) c, len(any_value(ws)) n from w where len(ws)>0 group by 1),
        t as (select rep, n, c, unnest(k) x from g), p as (select a.rep da, b.rep db, count(*) o, any_value(a.n) na, any_value(b.n) nb, any_value(a.c) ca, any_value(b.c) cb
          from t a join t b on a.x=b.x and a.rep<b.rep group by 1,2)
        select da doc_a, db doc_b, o::double/(na+nb-o) similarity, ca copies_a, cb copies_b from p where o::double/(na+nb-o)>0.5
        union all select rep, doc_id, 1.0, c, c from w join g on list_sort(ws)=k where doc_id<>rep"""
    sim1 = _TEXT + _PAIRS + f""", z as (select doc_id, list_distinct({_tok()}) ws from shop_text)
        select doc_a, doc_b, coalesce(len(list_intersect(a.ws,b.ws))::double/nullif(len(list_distinct(list_concat(a.ws,b.ws))),0),0) similarity
        from pr join z a on a.doc_id=doc_a join z b on b.doc_id=doc_b"""
    sim2 = _WORDS + _PAIRS + """, c as (select doc_id, w, count(*) n from wd group by 1,2), nm as (select doc_id, sqrt(sum(n*n)::double) m from c group by 1),
        dt as (select doc_a, doc_b, sum(x.n*y.n) d from pr join c x on x.doc_id=doc_a join c y on y.doc_id=doc_b and x.w=y.w group by 1,2)
        select doc_a, doc_b, coalesce(round(d::double/(a.m*b.m),4),0) similarity from pr join shop_text s on s.doc_id=doc_b left join dt using (doc_a, doc_b)
        left join nm a on a.doc_id=doc_a left join nm b on b.doc_id=doc_b"""
    audit = _TEXT + " union all ".join(
        f"select source, '{m}' as mode, count(*) filter (where c<>text) changed_rows, sum(length(text)-length(c))::bigint removed_chars from (select *, {e} c from shop_text) group by 1"
        for m, e in _CLEAN1.items())
    return {
        "corpus_sentiment": _S1 + "select * from lb", "corpus_sentiment_v2": _S2 + "select * from lb",
        "sentiment_by_language": _S1 + "select lang, sentiment, count(*) documents from lb group by 1,2",
        "corpus_keywords": _WORDS + _K1 + "select doc_id, coalesce(keywords,'') keywords from shop_text left join ks using (doc_id)",
        "corpus_keywords_v2": _WORDS + _K2 + "select doc_id, coalesce(keywords,'') keywords from shop_text left join ks using (doc_id)",
        "text_similarity_pairs": sim1, "text_similarity_pairs_v2": sim2, "text_similarity_join": join,
        "corpus_word_count": _TEXT + f"select doc_id, {_WC1} word_count from shop_text",
        "corpus_word_count_v2": _TEXT + f"select doc_id, {_WC2} word_count from shop_text",
        "corpus_language_profile": _TEXT + f"select lang, {_L1} as language, count(*) documents from shop_text group by 1,2",
        "corpus_language_profile_v2": _TEXT + f"select lang, {_L2} as language, count(*) documents from shop_text group by 1,2",
        "corpus_clean": _clean(_CLEAN1["all"]), "corpus_clean_v2": _clean(_ALL2), "corpus_clean_html": _clean(_HTML1), "clean_audit": audit,
        "name_standardize_job": _names(_title1(_N), _PLAIN, _slug1(_N)),
        "name_standardize_job_v2": _names(_title2(_N), _jtrim(_PLAIN), _slug2(_N)),
        "pii_mask_job": _pii(_mask1("email"), _mask_tel("phone")) + "select * from pm",
        "pii_mask_job_v2": _pii(_mask2("email"), "phone") + "select * from pm",
        "pii_mask_counts": _pii(_mask1("email"), _mask_tel("phone")) + """select country, count(*) total_rows, count(*) filter (where email_masked) masked_emails,
            count(*) filter (where phone_masked) masked_phones from pm group by 1""",
        "pii_mask_text": _TEXT + _MASKED + "select doc_id, c<>text as changed, md5(c) digest from m2",
        "pii_mask_text_left": "select 0::bigint emails_left, 0::bigint phones_left",
        "contact_validation_report": _DC + f"""select country, count(*) filter (where {_is_mail('email')}) valid_emails, count(*) filter (where not {_is_mail('email')}) invalid_emails,
            count(*)-count(email) missing_emails, count(*) filter (where regexp_matches(phone,{_PHONE})) valid_phones,
            count(*) filter (where not regexp_matches(phone,{_PHONE})) invalid_phones, count(*)-count(phone) missing_phones from dirty_customers group by 1""",
        "text_shape_job": _shape(True), "text_shape_job_v2": _shape(False),
        "text_shape_summary": _TEXT + f"""select source, count(*) documents, sum(len({_split('text')}))::bigint words, sum(length(text))::bigint chars, max(length(text)) longest,
            sum({_count('text', '0-9')})::bigint digits, sum({_count('text', 'a-zA-Z')})::bigint letters from shop_text group by 1""",
        "string_utils_sql": _utils(False), "string_utils_sql_v2": _utils(True),
        "text_functions_sql": _functions(False), "text_functions_sql_v2": _functions(True),
    }
