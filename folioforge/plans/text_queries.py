"""Queries of the text, reply, similarity and label operators."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioforge.functions import errors, sequence, similarity, text
from folioforge.functions import sql as sql_functions
from folioforge.operators import dedup, linkage
from folioforge.operators.partitioning import spread
from folioforge.plans.catalog import query
from folioforge.sources.tables import table

# Parts of the oracle SQL that several queries share. The test tables hold six entities only.
_WS = r"[\s\x0b\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
_HIDDEN = r"<!--[\s\S]*?-->|<script[\s\S]*?</script>|<style[\s\S]*?</style>|</?[A-Za-z][^>]*>"
UNESCAPE = "replace(replace(replace(replace(replace(replace({0}, '&nbsp;', chr(160)), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', chr(39)), '&amp;', '&')"


def _fill(sql: str, x: str) -> str:
    return sql.replace("{0}", x)


def _trimmed(x: str) -> str:
    return f"regexp_replace({x}, '^{_WS}+|{_WS}+$', '', 'g')"


def _collapsed(x: str) -> str:
    return f"trim(regexp_replace({x}, '{_WS}+', ' ', 'g'))"


def _plain(x: str) -> str:
    """SQL of strip_tags."""
    parts = f"list_filter([{_trimmed(_fill(UNESCAPE, 'v'))} for v in regexp_split_to_array({x}, '{_HIDDEN}')], lambda v: v <> '')"
    return f"CASE WHEN contains({x}, '<') AND contains({x}, '>') THEN array_to_string({parts}, ' ') ELSE {x} END"


_STEP = r"regexp_replace({0}, '[\x00-\x09\x0b\x0c\x0e-\x1f\x7f-\x9f\p{Cf}]', '', 'g')"


def basic_ctes(name: str, source: str) -> str:
    """SQL: a relation (t, n) of the distinct texts of a one-column query and their normal form."""
    lowered = _fill(UNESCAPE, f"lower({_trimmed(_fill(_STEP, 't'))})")
    return f"{name}_a AS (SELECT DISTINCT t, {lowered} AS s FROM ({source}) x(t)), {name} AS (SELECT t, {_collapsed(_plain('s'))} AS n FROM {name}_a)"


def decomposition_values() -> str:
    """SQL rows of characters that compatibility decomposition changes, in the alphabets in use."""
    ranges = (range(0xA0, 0x3001), range(0xFB00, 0xFB07), range(0xFF00, 0xFFF0))
    pairs = ((chr(c), unicodedata.normalize("NFKD", chr(c))) for r in ranges for c in r)
    return ", ".join(f"('{a}', '{b}')" for a, b in ((a, b.replace("'", "''")) for a, b in pairs if a != b))


def verbatim_ctes(name: str, source: str) -> str:
    """SQL: the same for the verbatim form; characters are decomposed by a join."""
    bare = _fill(UNESCAPE, _fill(UNESCAPE, f"regexp_replace(t, '{_HIDDEN}', '', 'g')"))
    return f"""{name}_d(c, d) AS (VALUES {decomposition_values()}),
    {name}_a AS (SELECT DISTINCT t, lower({bare}) AS s FROM ({source}) x(t)),
    {name}_b AS (SELECT t, string_agg(coalesce(d, c), '' ORDER BY k) AS s FROM (SELECT t, unnest(cs) AS c, generate_subscripts(cs, 1) AS k FROM (SELECT t, regexp_extract_all(s, '[\\s\\S]') AS cs FROM {name}_a WHERE regexp_matches(s, '[^\\x00-\\x7f]'))) LEFT JOIN {name}_d USING (c) GROUP BY t),
    {name} AS (SELECT t, {_collapsed(r"regexp_replace(coalesce(b.s, a.s), '[^\p{L}\p{N}\s\x0b\x{85}\x{1680}\x{2028}\x{2029}]', '', 'g')")} AS n FROM {name}_a a LEFT JOIN {name}_b b USING (t))"""


@query(f"SELECT extraction_id, md5(plain) AS plain_md5, length(plain) AS plain_length FROM (SELECT extraction_id, {_plain('figure_caption')} AS plain FROM caption_extraction)")
def q01_strip_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    plain = text.strip_tags(F.col("figure_caption"))
    rows = spread(table(spark, sf_dir, "caption_extraction").select("extraction_id", "figure_caption")).select("extraction_id", plain.alias("plain"))
    return rows.select("extraction_id", F.md5("plain").alias("plain_md5"), F.char_length("plain").cast("bigint").alias("plain_length"))


@query(r"""SELECT section_id, md5(regexp_replace('<ul><li> </li><li>' || data_availability || '</li><li>&nbsp;<br/></li></ul>', '(?i)<li>(?:\s|&nbsp;| |<br\s*/?>)*</li>', '', 'g')) AS clean_md5 FROM extracted_sections WHERE data_availability IS NOT NULL""")
def q02_sanitize_list_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "extracted_sections").where("data_availability IS NOT NULL")
    padded = F.concat(F.lit("<ul><li> </li><li>"), "data_availability", F.lit("</li><li>&nbsp;<br/></li></ul>"))
    return rows.select("section_id", F.md5(text.drop_empty_items(padded)).alias("clean_md5"))


@query(f"WITH {basic_ctes('f', 'SELECT panel_caption FROM panel_info')} SELECT panel_info_id, md5(n) AS norm_md5 FROM panel_info LEFT JOIN f ON panel_caption = t")
def q03_normalize_basic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "panel_info").select("panel_info_id", "panel_caption")).select("panel_info_id", F.md5(text.normalize_basic(F.col("panel_caption"))).alias("norm_md5"))


@query(f"""WITH {basic_ctes("g", "SELECT panel_caption FROM panel_list")}, d(c, d) AS (VALUES {decomposition_values()}), p AS (SELECT t, regexp_replace(n, '[!-,./:-@\\[-`{{-~]', ' ', 'g') AS n FROM g),
    cs AS (SELECT t, unnest(regexp_extract_all(n, '[\\s\\S]')) AS c, generate_subscripts(regexp_extract_all(n, '[\\s\\S]'), 1) AS k FROM p),
    a AS (SELECT t, string_agg(regexp_replace(coalesce(d, c), '[^\\x00-\\x7f]', '', 'g'), '' ORDER BY k) AS s FROM cs LEFT JOIN d USING (c) GROUP BY t)
    SELECT panel_id, CASE WHEN panel_caption IS NOT NULL THEN {_collapsed("coalesce(s, '')")} END AS norm FROM panel_list LEFT JOIN a ON panel_caption = t""")
def q03b_normalize_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All steps: punctuation but the hyphen to blanks, and ASCII only."""
    return table(spark, sf_dir, "panel_list").select("panel_id", text.normalize(F.col("panel_caption"), punctuation=True, keep="-", ascii_only=True).alias("norm"))


@query(f"WITH {verbatim_ctes('f', 'SELECT text FROM documents')} SELECT doc_id, md5(n) AS norm_md5 FROM documents LEFT JOIN f ON text = t")
def q04_normalize_verbatim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", F.md5(text.normalize_verbatim(F.col("text"))).alias("norm_md5"))


@query(rf"""SELECT section_id, {_collapsed("regexp_replace(" + _fill(UNESCAPE, "regexp_replace('Data  availability: ' || data_availability, '(?i)^data' || chr(92) || 's+availability' || chr(92) || 's*[:.]?' || chr(92) || 's*', '')") + ", '<[^>]+>', '', 'g')")} AS norm FROM extracted_sections""")
def q04b_normalize_scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Availability sections as they are scored: without their heading, tags and repeated blanks."""
    headed = F.concat(F.lit("Data  availability: "), "data_availability")
    return table(spark, sf_dir, "extracted_sections").select("section_id", text.normalize_scored(headed, squeeze=True, availability=True).alias("norm"))


_LATEST_SECTION = "SELECT manuscript_id, arg_max(figure_legends, (extracted_at, section_id)) AS legends FROM (SELECT * FROM extracted_sections WHERE figure_legends IS NOT NULL) GROUP BY manuscript_id"


def _panel_captions(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "panel_info").select("panel_info_id", "manuscript_id", "source", "panel_caption")
    return spread(rows).select("panel_info_id", "manuscript_id", "source", text.normalize_basic(F.col("panel_caption")).alias("caption"))


def _verbatim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel captions against the latest legends of their manuscript, both normalised."""
    sections = table(spark, sf_dir, "extracted_sections").where("figure_legends IS NOT NULL")
    sources = dedup.latest(sections.select("manuscript_id", "extracted_at", "section_id", "figure_legends"), ["manuscript_id"], "extracted_at", "section_id")
    sources = sources.select("manuscript_id", text.normalize_basic(F.col("figure_legends")).alias("legends"))
    return linkage.contained(_panel_captions(spark, sf_dir), sources, "manuscript_id", "caption", "legends")


_VERBATIM_SQL = f"""
    WITH {basic_ctes("fs", f"SELECT legends FROM ({_LATEST_SECTION})")}, {basic_ctes("fp", "SELECT panel_caption FROM panel_info")},
    s AS (SELECT manuscript_id, n AS legends FROM ({_LATEST_SECTION}) JOIN fs ON legends = t),
    p AS (SELECT panel_info_id, manuscript_id, source, n AS caption FROM panel_info LEFT JOIN fp ON panel_caption = t)
    SELECT panel_info_id, source, caption, coalesce(contains(legends, caption) AND caption <> '', false) AS is_verbatim FROM p LEFT JOIN s USING (manuscript_id)
"""


@query(f"SELECT panel_info_id, is_verbatim FROM ({_VERBATIM_SQL})")
def q05_verbatim_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verbatim(spark, sf_dir).select("panel_info_id", "is_verbatim")


@query(f"SELECT source, count(*) AS n, sum(CASE WHEN coalesce(caption, '') = '' OR NOT is_verbatim THEN 1.0 ELSE 0.0 END)::DOUBLE AS total_score FROM ({_VERBATIM_SQL}) GROUP BY source")
def q06_hallucination_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.when(F.col("is_verbatim"), 0.0).otherwise(1.0)
    return _verbatim(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"), F.sum(score).alias("total_score"))


def _verbatim_in_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel captions against all legends that any section row of their manuscript has."""
    sections = spread(table(spark, sf_dir, "extracted_sections").select("manuscript_id", "figure_legends").where("figure_legends IS NOT NULL").distinct())
    sources = sections.select("manuscript_id", text.normalize_basic(F.col("figure_legends")).alias("legends"))
    return linkage.contained_in_any(_panel_captions(spark, sf_dir), sources, "manuscript_id", "caption", "legends")


_VERBATIM_IN_ANY_SQL = f"""
    WITH {basic_ctes("fs", "SELECT figure_legends FROM extracted_sections")}, {basic_ctes("fp", "SELECT panel_caption FROM panel_info")},
    s AS (SELECT DISTINCT manuscript_id, n AS legends FROM extracted_sections JOIN fs ON figure_legends = t),
    p AS (SELECT panel_info_id, manuscript_id, source, n AS caption FROM panel_info LEFT JOIN fp ON panel_caption = t),
    h AS (SELECT DISTINCT manuscript_id, caption, true AS hit FROM (SELECT DISTINCT manuscript_id, caption FROM p WHERE caption <> '') JOIN s USING (manuscript_id) WHERE contains(legends, caption))
    SELECT panel_info_id, source, coalesce(hit, false) AS is_verbatim FROM p LEFT JOIN h USING (manuscript_id, caption)
"""


@query(f"SELECT panel_info_id, is_verbatim FROM ({_VERBATIM_IN_ANY_SQL})")
def q05b_verbatim_any_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _verbatim_in_any(spark, sf_dir).select("panel_info_id", "is_verbatim")


@query(f"SELECT source, count(*) AS n, sum(CASE WHEN is_verbatim THEN 0.0 ELSE 1.0 END)::DOUBLE AS total_score FROM ({_VERBATIM_IN_ANY_SQL}) GROUP BY source")
def q06b_hallucination_any_section(spark: SparkSession, sf_dir: str) -> DataFrame:
    score = F.when(F.col("is_verbatim"), 0.0).otherwise(1.0)
    return _verbatim_in_any(spark, sf_dir).groupBy("source").agg(F.count("*").alias("n"), F.sum(score).alias("total_score"))


@query()
def q07_hallucination_full(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of individual captions against their panels' text: exact ones in the JVM, the rest by likeness."""
    pairs = _caption_pairs(spark, sf_dir).select("panel_id", text.normalize_basic(F.col("a")).alias("a"), text.normalize_basic(F.col("b")).alias("b"))
    exact = F.contains("b", "a") & (F.length("a") > 0)
    known = pairs.where(exact | F.col("a").isNull() | F.col("b").isNull() | (F.length("a") == 0)).select("panel_id", F.when(exact, 0.0).otherwise(1.0).alias("score"))
    rest = pairs.where(~exact & (F.length("a") > 0)).select("panel_id", F.round(similarity.invention_score(F.col("a"), F.col("b")), 6).alias("score"))
    return known.unionByName(rest)


def _caption_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each panel's caption (a) with the caption of its figure (b)."""
    figures = table(spark, sf_dir, "individual_caption").select("caption_id", F.col("figure_caption").alias("b"))
    return spread(table(spark, sf_dir, "panel_list").select("panel_id", "caption_id", F.col("panel_caption").alias("a"))).join(figures, "caption_id")


def _word_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = lambda c: similarity.word_array(F.coalesce(text.normalize_verbatim(F.col(c)), F.lit("")))
    return _caption_pairs(spark, sf_dir).select("panel_id", words("a").alias("a"), words("b").alias("b"))


_PAIRS = f"""{verbatim_ctes("f", "SELECT panel_caption FROM panel_list UNION ALL SELECT figure_caption FROM individual_caption")},
    pairs AS (SELECT panel_id, list_filter(string_split(coalesce(x.n, ''), ' '), lambda w: w <> '') AS a, list_filter(string_split(coalesce(y.n, ''), ' '), lambda w: w <> '') AS b
              FROM panel_list JOIN individual_caption USING (caption_id) LEFT JOIN f x ON panel_caption = x.t LEFT JOIN f y ON figure_caption = y.t)
"""


@query(f"""WITH {_PAIRS} SELECT panel_id, round(CASE WHEN len(list_distinct(list_concat(a, b))) = 0 THEN 1.0
    ELSE len(list_intersect(list_distinct(a), list_distinct(b)))::DOUBLE / len(list_distinct(list_concat(a, b))) END, 6) AS jaccard FROM pairs""")
def q08_word_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _word_pairs(spark, sf_dir).select("panel_id", F.round(similarity.jaccard(F.col("a"), F.col("b")), 6).alias("jaccard"))


_GRAMS = """
    ga AS (SELECT panel_id, g, count(*) AS x FROM (SELECT panel_id, unnest({0}) AS g FROM pairs) GROUP BY ALL),
    gb AS (SELECT panel_id, g, count(*) AS y FROM (SELECT panel_id, unnest({1}) AS g FROM pairs) GROUP BY ALL),
    h AS (SELECT panel_id, sum(least(x, y)) AS hits FROM ga JOIN gb USING (panel_id, g) GROUP BY panel_id),
    o AS (SELECT panel_id, coalesce(hits, 0)::DOUBLE AS hits, {2}::DOUBLE AS n_a, {3}::DOUBLE AS n_b FROM pairs LEFT JOIN h USING (panel_id))
"""


@query(f"""WITH {_PAIRS}, {_GRAMS.format("a", "b", "len(a)", "len(b)")}
    SELECT panel_id, round(CASE WHEN n_a = 0 OR n_b = 0 THEN 0.0 ELSE (CASE WHEN n_a >= n_b THEN 1.0 ELSE exp(1 - n_b / n_a) END) * hits / n_a END, 6) AS bleu1 FROM o""")
def q09_bleu1(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = similarity.overlap(_word_pairs(spark, sf_dir), "panel_id", "a", "b")
    return got.select("panel_id", F.round(similarity.bleu1(F.col("hits"), F.col("n_a"), F.col("n_b")), 6).alias("bleu1"))


_BI = "[{0}[i] || ' ' || {0}[i + 1] for i in range(1, greatest(len({0}), 1))]"


@query(f"""WITH {_PAIRS}, {_GRAMS.format(_BI.format("a"), _BI.format("b"), "greatest(len(a) - 1, 0)", "greatest(len(b) - 1, 0)")}
    SELECT panel_id, round(CASE WHEN n_a + n_b = 0 THEN 0.0 ELSE 2 * hits / (n_a + n_b) END, 6) AS rouge2 FROM o""")
def q10_rouge2(spark: SparkSession, sf_dir: str) -> DataFrame:
    got = similarity.overlap(_word_pairs(spark, sf_dir), "panel_id", "a", "b", 2)
    return got.select("panel_id", F.round(similarity.rouge(F.col("hits"), F.col("n_b"), F.col("n_a")), 6).alias("rouge2"))


@query()
def q10b_rouge_l(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _word_pairs(spark, sf_dir).select("panel_id", F.round(similarity.rouge_l(F.col("a"), F.col("b")), 6).alias("rouge_l"))


@query(rf"""WITH e AS (SELECT doc_id, length(text) AS n_chars, {_collapsed("text")} AS s FROM documents)
    SELECT doc_id, n_chars, md5(CASE WHEN length(s) > 160 THEN substring(s, 1, 160) || '...' ELSE s END) AS excerpt_md5 FROM e""")
def q13_excerpt(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents").select("doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.md5(text.excerpt(F.col("text"))).alias("excerpt_md5"))


@query("""SELECT manuscript_id, sum(3 + length(coalesce(figure_caption, '')) // 4 + length(source) // 4)::BIGINT + 3 AS n_tokens FROM caption_extraction GROUP BY manuscript_id""")
def q14_message_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Captions as the messages of one request for each manuscript: 3 a message, 3 a reply."""
    each = 3 + text.tokens(F.coalesce("figure_caption", F.lit(""))) + text.tokens(F.col("source"))
    return table(spark, sf_dir, "caption_extraction").groupBy("manuscript_id").agg((F.sum(each) + 3).alias("n_tokens"))


@query(rf"""WITH m AS (SELECT manuscript_id, extraction_id, source, coalesce(figure_caption, '') AS t, {_collapsed("coalesce(figure_caption, '')")} AS s FROM caption_extraction)
    SELECT manuscript_id, count(*) AS n_messages, sum(length(t))::BIGINT AS n_chars,
           md5(arg_min(CASE WHEN length(s) > 160 THEN substring(s, 1, 160) || '...' ELSE s END, extraction_id) FILTER (WHERE source LIKE 'api%' AND s <> '')) AS first_md5 FROM m GROUP BY manuscript_id""")
def q15_message_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "caption_extraction").withColumn("t", F.coalesce("figure_caption", F.lit("")))
    shown = text.excerpt(F.col("t"))
    first = F.min_by(F.when(F.col("source").startswith("api") & (shown != ""), shown), F.when(F.col("source").startswith("api") & (shown != ""), F.col("extraction_id")))
    return rows.groupBy("manuscript_id").agg(F.count("*").alias("n_messages"), F.sum(F.char_length("t")).alias("n_chars"), F.md5(first).alias("first_md5"))


_ERRORS = {
    0: ("BadRequestError", "This model''s maximum context length is 128,000 tokens, however you requested 131,072 tokens"),
    1: ("LengthFinishReasonError", "response was truncated"),
    2: ("BadRequestError", "invalid_prompt: limited access to this content for safety reasons"),
    3: ("RateLimitError", "slow down"),
    4: ("APIStatusError", "upstream returned 503"),
    5: ("AuthenticationError", "bad key"),
    6: ("ValueError", "no such thing"),
}
_ERROR_SQL = " UNION ALL ".join(f"SELECT {k} AS k, '{n}' AS name, '{m}' AS message" for k, (n, m) in _ERRORS.items())


@query(f"""WITH e AS ({_ERROR_SQL}), f AS (SELECT event_id, name, lower(message) AS m FROM events JOIN e ON event_id % 7 = k),
    r AS (SELECT event_id, CASE
        WHEN regexp_matches(m, 'context length|maximum context|token limit|too long|context window|context_window_exceeded|maximum tokens|length limit|context_length_exceeded') THEN 'context_length'
        WHEN regexp_matches(m, 'lengthfinishreasonerror|finish_reason|response was truncated') THEN 'output_length_limit'
        WHEN regexp_matches(m, 'invalid_prompt|safety reasons|limited access to this content|content_policy_violation|content policy') THEN 'safety_block'
        WHEN name IN ('RateLimitError', 'APIConnectionError', 'APITimeoutError', 'InternalServerError', 'OverloadedError')
          OR regexp_matches(m, 'timed out|timeout|rate limit|overloaded|temporarily unavailable|connection reset|503|504|502') THEN 'transient_api_error'
        WHEN name = 'BadRequestError' THEN 'invalid_request' WHEN name = 'AuthenticationError' THEN 'authentication_error'
        ELSE 'unexpected_error' END AS reason, try_cast(replace(nullif(regexp_extract(m, 'you requested\\s*([0-9,]+)\\s*tokens', 1), ''), ',', '') AS BIGINT) AS requested FROM f)
    SELECT reason, CASE WHEN reason IN ('context_length', 'output_length_limit', 'safety_block', 'transient_api_error') THEN 'recoverable' ELSE 'critical' END AS severity, count(*) AS n, max(requested) AS requested FROM r GROUP BY ALL""")
def q20_error_classify(spark: SparkSession, sf_dir: str) -> DataFrame:
    known = F.create_map(*[x for k, (n, m) in _ERRORS.items() for x in (F.lit(k), F.struct(F.lit(n).alias("name"), F.lit(m.replace("''", "'")).alias("message")))])
    rows = table(spark, sf_dir, "events").select(known[(F.col("event_id") % 7).cast("int")].alias("e"))
    why = errors.reason(F.col("e.name"), F.col("e.message"))
    got = rows.select(why.alias("reason"), errors.requested_tokens(F.col("e.message")).alias("requested"))
    return got.groupBy("reason").agg(F.count("*").alias("n"), F.max("requested").alias("requested")).withColumn("severity", errors.severity(F.col("reason")))


@query(f"""WITH e AS ({_ERROR_SQL} UNION ALL SELECT 7, 'OverloadedError', 'busy' UNION ALL SELECT 8, 'APIStatusError', 'Overloaded, 12,000 in your prompt; 800 for completion'), f AS (SELECT event_id, name, message AS raw, lower(message) AS m, ['openai', 'anthropic'][event_id % 2 + 1] AS provider FROM events JOIN e ON event_id % 9 = k),
    r AS (SELECT *, CASE
        WHEN provider = 'openai' AND regexp_matches(m, 'maximum context') THEN 'context_length' WHEN provider = 'openai' AND regexp_matches(m, 'response was truncated') THEN 'output_length_limit' WHEN provider = 'openai' AND regexp_matches(m, 'invalid_prompt') THEN 'safety_block'
        WHEN name = 'RateLimitError' OR contains(m, '503') OR provider = 'anthropic' AND (name = 'OverloadedError' OR contains(m, 'overloaded')) THEN 'transient_api_error'
        WHEN name = 'BadRequestError' THEN 'invalid_request' WHEN name = 'AuthenticationError' THEN 'authentication_error' ELSE 'unexpected_error' END AS reason FROM f)
    SELECT provider, reason, count(*) AS n, max(try_cast(replace(regexp_extract(m, 'maximum context length is ([0-9,]+) tokens', 1), ',', '') AS BIGINT)) AS max_context, max(try_cast(replace(regexp_extract(m, '([0-9,]+) in your prompt', 1), ',', '') AS BIGINT)) AS prompt,
        max(try_cast(replace(regexp_extract(m, '([0-9,]+) for completion', 1), ',', '') AS BIGINT)) AS completion FROM r GROUP BY ALL""")
def q20b_error_providers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Errors by the lists of their provider, with the token counts that their messages state."""
    listed = [*_ERRORS.values(), ("OverloadedError", "busy"), ("APIStatusError", "Overloaded, 12,000 in your prompt; 800 for completion")]
    known = F.create_map(*[x for k, (n, m) in enumerate(listed) for x in (F.lit(k), F.struct(F.lit(n).alias("name"), F.lit(m.replace("''", "'")).alias("message")))])
    provider = F.when(F.col("event_id") % 2 == 0, "openai").otherwise("anthropic")
    rows = table(spark, sf_dir, "events").select(provider.alias("provider"), known[(F.col("event_id") % 9).cast("int")].alias("e"))
    got = rows.select("provider", errors.reason(F.col("e.name"), F.col("e.message"), F.col("provider")).alias("reason"), errors.token_details(F.col("e.message")).alias("t"))
    return got.groupBy("provider", "reason").agg(F.count("*").alias("n"), *[F.max(f"t.{c}").alias(c) for c in ("max_context", "prompt", "completion")])


@query(r"SELECT panel_info_id, coalesce(nullif(regexp_extract(upper(panel_label), '([A-Z])[0-9]*$', 1), ''), upper(panel_label)) AS label FROM panel_info")
def q21_panel_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "panel_info").select("panel_info_id", text.panel_label(F.col("panel_label")).alias("label"))


@query(r"""SELECT extraction_id, CASE WHEN regexp_replace(figure_label, '[^0-9]', '', 'g') <> '' THEN 'Figure ' || regexp_replace(figure_label, '[^0-9]', '', 'g') ELSE figure_label END AS label,
    regexp_matches(figure_label, '(?i)ev|extended view|expanded view|extended data') AS is_expanded FROM caption_extraction WHERE NOT contains(figure_label, 'EV')""")
def q22_figure_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "caption_extraction").where(~F.col("figure_label").contains("EV"))
    return rows.select("extraction_id", text.figure_label(F.col("figure_label")).alias("label"), F.col("figure_label").rlike(text.EXPANDED_VIEW).alias("is_expanded"))


@query(r"""WITH p AS (SELECT doc_id, string_split(manuscript_id || '/' || section || '/' || doc_id, '/') AS s FROM documents WHERE manuscript_id IS NOT NULL)
    SELECT doc_id, CASE WHEN contains(s[1], '-') AND regexp_matches(s[1], '[0-9]') AND len(s) > 1 THEN array_to_string(s[2:], '/') ELSE array_to_string(s, '/') END AS path FROM p""")
def q23_clean_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").where("manuscript_id IS NOT NULL")
    return rows.select("doc_id", text.clean_path(F.concat_ws("/", "manuscript_id", "section", F.col("doc_id").cast("string"))).alias("path"))


_MEMBER = "CASE p_partkey % 6 WHEN 0 THEN 'data/' || p_name || '.csv' WHEN 1 THEN '__MACOSX/' || p_name WHEN 2 THEN p_name || '/' WHEN 3 THEN '.hidden' WHEN 4 THEN 'x/Thumbs.db' ELSE p_brand || '.xlsx' END"


@query(f"""SELECT p_partkey, 'archive.zip:' || m AS member, lower(regexp_replace(translate(m, ' /\\', '___'), '[^A-Za-z0-9._-]', '', 'g')) AS safe_name FROM (SELECT p_partkey, {_MEMBER} AS m FROM part)
    WHERE NOT (m LIKE '%/' OR contains(m, '__MACOSX') OR contains(m, 'Thumbs.db') OR contains(m, 'desktop.ini') OR contains(m, '.DS_Store') OR m LIKE '.%')""")
def q24_archive_members(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select("p_partkey", F.expr(_MEMBER).alias("m")).where(text.is_data_member(F.col("m")))
    return rows.select("p_partkey", F.concat_ws(":", F.lit("archive.zip"), "m").alias("member"), text.file_name(F.col("m")).alias("safe_name"))


@query(f"""WITH {verbatim_ctes("f", "SELECT panel_caption FROM panel_list UNION ALL SELECT figure_caption FROM individual_caption")}
    SELECT panel_id, coalesce(contains(y.n, x.n) AND panel_caption <> '' AND figure_caption <> '', false) AS is_verbatim,
    CASE WHEN coalesce(panel_caption, '') = '' OR coalesce(figure_caption, '') = '' THEN 'One or both texts are empty' WHEN contains(y.n, x.n) THEN 'The extraction is verbatim' ELSE 'The extraction is NOT verbatim' END AS details
    FROM panel_list JOIN individual_caption USING (caption_id) LEFT JOIN f x ON panel_caption = x.t LEFT JOIN f y ON figure_caption = y.t""")
def q71_sql_verify_caption(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Panel captions checked against the caption of their figure by the registered function."""
    sql_functions.register(spark)
    pairs = spark.sql("SELECT panel_id, verify_caption_extraction(a, b) AS v FROM {pairs}", pairs=_caption_pairs(spark, sf_dir))
    return pairs.select("panel_id", "v.is_verbatim", "v.details")


@query("""WITH l AS (SELECT caption_id, list(regexp_replace(panel_label, '[().\\s]', '', 'g') ORDER BY panel_id) AS labels FROM panel_list WHERE panel_label IS NOT NULL GROUP BY caption_id),
    w AS (SELECT *, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS abc FROM l WHERE regexp_full_match(labels[1], '[A-HJ-UW]')),
    v AS (SELECT *, CASE WHEN contains(abc, labels[-1]) THEN [abc[i::INTEGER] for i in range(strpos(abc, labels[1]), strpos(abc, labels[-1]) + 1)] END AS want FROM w)
    SELECT caption_id, coalesce(labels = want, false) AS is_valid, array_to_string(coalesce(want, labels), ',') AS fixed FROM v""")
def q72_sql_verify_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lists of labels that begin with a capital letter, by the registered function."""
    sql_functions.register(spark)
    rows = table(spark, sf_dir, "panel_list").where("panel_label IS NOT NULL")
    lists = rows.groupBy("caption_id").agg(F.array_sort(F.collect_list(F.struct("panel_id", "panel_label"))).alias("r"))  # tens of panels a caption
    got = spark.sql("SELECT caption_id, r[0].panel_label AS first, verify_panel_sequence(r.panel_label) AS v FROM {lists}", lists=lists)
    return got.where(F.regexp_replace("first", r"[().\s]", "").rlike("^[A-HJ-UW]$")).select("caption_id", "v.is_valid", F.array_join("v.fixed_sequence", ",").alias("fixed"))


def _label_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels of each caption's panels in order; a caption has tens of panels at most."""
    rows = table(spark, sf_dir, "panel_list").where("panel_label IS NOT NULL")
    lists = rows.groupBy("caption_id").agg(F.array_sort(F.collect_list(F.struct("panel_id", "panel_label"))).alias("r"))
    return lists.select("caption_id", sequence.bare_labels(F.col("r.panel_label")).alias("labels"))


# Labels of a caption as they come, and three invented lists of each other family beside them.
_LISTS_SQL = r"""l AS (SELECT caption_id, 0 AS kind, list(regexp_replace(panel_label, '[().\s]', '', 'g') ORDER BY panel_id) AS labels FROM panel_list WHERE panel_label IS NOT NULL GROUP BY caption_id
    UNION ALL SELECT p_partkey, 1, [v::VARCHAR for v in range(p_partkey % 4, p_partkey % 4 + p_size % 5 + 1) if v <> p_size % 7] FROM part
    UNION ALL SELECT p_partkey, 2, [rn[v::INTEGER] for v in range(1, p_size % 12 + 2) if v <> p_partkey % 5] FROM part, (SELECT ['I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX', 'X', 'XI', 'XII', 'XIII'] AS rn)
    UNION ALL SELECT p_partkey, 3, CASE p_partkey % 3 WHEN 0 THEN ['1', 'x'] WHEN 1 THEN ['I', 'IIII'] ELSE ['?', 'A'] END FROM part)"""
_KIND_SQL = r"""CASE WHEN labels[1] IN ('I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX', 'X') THEN 'roman' WHEN contains('ABCDEFGHIJKLMNOPQRSTUVWXYZ', labels[1]) THEN 'upper'
    WHEN contains('abcdefghijklmnopqrstuvwxyz', labels[1]) THEN 'lower' WHEN regexp_full_match(labels[1], '[0-9]+') THEN 'digits' ELSE 'invalid' END"""


_ROMANS = ", ".join(f"'{t}{u}'" for t in ("", "X", "XX", "XXX") for u in ("", "I", "II", "III", "IV", "V", "VI", "VII", "VIII", "IX"))


@query(rf"""WITH r AS (SELECT list_filter([{_ROMANS}], lambda x: x <> '') AS rl), {_LISTS_SQL}, k AS (SELECT *, {_KIND_SQL} AS family, CASE WHEN {_KIND_SQL} = 'lower' THEN 'abcdefghijklmnopqrstuvwxyz' ELSE 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' END AS abc FROM l),
    v AS (SELECT *, [nullif(list_position(rl, upper(x)), 0) for x in labels] AS romans, [try_cast(x AS INTEGER) for x in labels] AS numbers FROM k, r),
    w AS (SELECT *, CASE WHEN len(labels) = 0 THEN NULL WHEN family IN ('upper', 'lower') THEN CASE WHEN contains(abc, labels[1]) AND contains(abc, labels[-1]) THEN [abc[i::INTEGER] for i in range(strpos(abc, labels[1]), strpos(abc, labels[-1]) + 1)] END
        WHEN family = 'digits' THEN CASE WHEN len(list_filter(numbers, lambda x: x IS NULL)) = 0 THEN [x::VARCHAR for x in range(numbers[1], numbers[-1] + 1)] END
        WHEN family = 'roman' THEN CASE WHEN len(list_filter(romans, lambda x: x IS NULL)) = 0 THEN rl[list_min(romans):list_max(romans)] END END AS want FROM v),
    o AS (SELECT *, coalesce(CASE WHEN family = 'roman' THEN len(list_distinct(romans)) = len(want) WHEN family = 'digits' THEN [x::VARCHAR for x in numbers] = want ELSE labels = want END, false) AS ok FROM w)
    SELECT caption_id, kind, CASE WHEN len(labels) = 0 THEN NULL ELSE family END AS family, ok AS is_valid, array_to_string(CASE WHEN len(labels) = 0 THEN [] ELSE coalesce(want, labels) END, ',') AS fixed,
        CASE WHEN len(labels) = 0 THEN 'No panel labels provided' WHEN ok THEN 'Sequence is valid' WHEN want IS NOT NULL THEN 'Sequence has gaps. Fixed sequence: ' || array_to_string(want, ', ') WHEN family = 'roman' THEN 'Invalid Roman numeral in sequence: ' || list_filter(labels, lambda x: NOT list_contains(rl, upper(x)))[1]
        WHEN family = 'digits' THEN 'Invalid numeric value in sequence' WHEN family = 'invalid' THEN 'Unable to determine sequence type from labels' ELSE 'Labels contain characters not in the expected alphabet' END AS details FROM o""")
def q30_panel_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every list of labels with its unbroken run and what is wrong: letters, numbers, Roman
    numerals and what is none of them."""
    k, n = F.col("p_partkey"), F.col("p_size")
    upto = lambda a, b: F.when(b >= a, F.sequence(a.cast("int"), b.cast("int"))).otherwise(F.array().cast("array<int>"))
    numbers = F.transform(F.filter(upto(k % 4, k % 4 + n % 5), lambda v: v != n % 7), lambda v: v.cast("string"))
    romans = F.transform(F.filter(upto(F.lit(1), n % 12 + 1), lambda v: v != k % 5), sequence.int_to_roman)
    odd = F.when(k % 3 == 0, F.array(F.lit("1"), F.lit("x"))).when(k % 3 == 1, F.array(F.lit("I"), F.lit("IIII"))).otherwise(F.array(F.lit("?"), F.lit("A")))
    kinds = F.array(*[F.struct(F.lit(i).alias("kind"), c.alias("labels")) for i, c in enumerate((numbers, romans, odd), 1)])
    invented = table(spark, sf_dir, "part").select(k.alias("caption_id"), F.inline(kinds))
    lists = _label_lists(spark, sf_dir).select("caption_id", F.lit(0).alias("kind"), "labels").unionByName(invented)
    family = F.when(F.size("labels") > 0, sequence.family(F.col("labels")))
    got = lists.select("caption_id", "kind", family.alias("family"), sequence.verify(F.col("labels")).alias("v"))
    return got.select("caption_id", "kind", "family", "v.is_valid", F.array_join("v.fixed_sequence", ",").alias("fixed"), "v.details")


@query("""WITH r AS (SELECT * FROM (VALUES (1000, 'M'), (900, 'CM'), (500, 'D'), (400, 'CD'), (100, 'C'), (90, 'XC'), (50, 'L'), (40, 'XL'), (10, 'X'), (9, 'IX'), (5, 'V'), (4, 'IV'), (1, 'I')) t(v, d)),
    n AS (SELECT DISTINCT (p_partkey % 4999 + 1)::INTEGER AS n FROM part)
    SELECT n, repeat('M', n // 1000) || ['', 'C', 'CC', 'CCC', 'CD', 'D', 'DC', 'DCC', 'DCCC', 'CM'][n // 100 % 10 + 1] || ['', 'X', 'XX', 'XXX', 'XL', 'L', 'LX', 'LXX', 'LXXX', 'XC'][n // 10 % 10 + 1]
        || ['', 'I', 'II', 'III', 'IV', 'V', 'VI', 'VII', 'VIII', 'IX'][n % 10 + 1] AS roman, n AS back FROM n""")
def q30b_roman(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "part").select((F.col("p_partkey") % 4999 + 1).cast("int").alias("n")).distinct()
    roman = sequence.int_to_roman(F.col("n"))
    return rows.select("n", roman.alias("roman"), sequence.roman_to_int(roman).alias("back"))


@query("""SELECT c_custkey, 'Dear ' || c_name || ', $unknown of ' || n_name AS letter FROM customer JOIN nation ON c_nationkey = n_nationkey""")
def q51_template_fill(spark: SparkSession, sf_dir: str) -> DataFrame:
    nations = linkage.small(table(spark, sf_dir, "nation"))
    rows = table(spark, sf_dir, "customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey"))
    return rows.select("c_custkey", text.fill_template("Dear $name, $unknown of $nation", {"name": F.col("c_name"), "nation": F.col("n_name")}).alias("letter"))


@query("""SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k FROM events""")
def q46_parse_reply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event properties wrapped as replies, fenced or bare, and read again."""
    reply = F.when(F.col("event_id") % 2 == 0, F.concat(F.lit("Sure:\n```json\n"), "props", F.lit("\n```\nDone."))).otherwise(F.concat(F.lit("Here: "), "props", F.lit(" ok")))
    return table(spark, sf_dir, "events").select("event_id", F.from_json(text.json_in_reply(reply), "k bigint")["k"].alias("k"))


@query()
def q54_ascii_fold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "individual_caption").select("caption_id", text.ascii_fold(F.col("figure_caption")).alias("folded"))


@query("""SELECT doc_id, regexp_extract(u, '^data:([^;,]+);base64,(.*)$', 1) AS mime, from_base64(regexp_extract(u, '^data:([^;,]+);base64,(.*)$', 2))::BLOB::VARCHAR AS payload FROM
    (SELECT doc_id, 'data:text/plain;base64,' || to_base64(section::BLOB) AS u FROM documents)""")
def q57_data_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.concat(F.lit("data:text/plain;base64,"), F.base64(F.col("section").cast("binary")))
    parts = table(spark, sf_dir, "documents").select("doc_id", text.data_url_parts(url).alias("p"))
    return parts.select("doc_id", "p.mime", F.unbase64("p.payload").cast("string").alias("payload"))
