import pytest
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import functions as F

from folioforge.functions import errors, sequence, similarity, sql, text


def one(spark, column, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()] or [F.lit(0)])
    return df.select(column.alias("r")).first().r


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("<p>A  <b>x</b>\n y</p>", "A x y"), ("<i>a  b</i>", "a  b"), ("p < 0.05 and q > 1", "p < 0.05 and q > 1"), ("a<!-- no\n -->b<script>x</script>c", "a b c"), ("", ""), (None, None), ("x" * 100_000, "x" * 100_000),
        (" no tags,  kept ", " no tags,  kept "), ("a &alpha; b", "a &alpha; b"), ("<b>&alpha;&#946;</b> &lt;i&gt;", "αβ <i>"), ("<!--" + "x" * 50_000 + "-->a<b>c</b>", "a c"),
    ],
)
def test_strip_tags(spark, raw, want):
    assert one(spark, text.strip_tags(F.lit(raw).cast("string"))) == want


def test_normalizers_differ_as_they_should(spark):
    raw = F.lit("Fig<b>A</b> &amp; B_c,  \x07D")
    assert one(spark, text.normalize_basic(raw)) == "fig a & b_c, d"
    assert one(spark, text.normalize_verbatim(F.lit("Fig<b>A</b> &amp; B_c,  D"))) == "figa bc d"


@pytest.mark.parametrize(
    ("raw", "want"),
    [
        ("A\u00ad\u200b\tB\x85C", "abc"), ("a\nb\r\nc", "a b c"), ("&ALPHA;&#x3b1; &Micro;&nbsp;x", "αα µ x"), ("&lt;b&gt;x&lt;/b&gt;y", "x y"), ("&amp;lt;i&amp;gt; <u>&amp;amp;</u>", "<i> &"),
        ("\u00a0 é \u2003", "é"), (None, None), ("", ""),
    ],
)
def test_basic_form(spark, raw, want):
    assert one(spark, text.normalize_basic(F.lit(raw).cast("string"))) == want


def test_all_steps_and_none(spark):
    raw = F.lit("Ｐ-value (n=3): É &beta; <b>x</b>")
    assert one(spark, text.normalize(raw, punctuation=True, keep="-", ascii_only=True)) == "p-value n 3 e x"
    assert one(spark, text.normalize(raw, control=False, lower=False, markup=False)) == "Ｐ-value (n=3): É &beta; <b>x</b>"


@pytest.mark.parametrize(("raw", "want"), [("é", "e"), ("e\u0301", "e"), ("ﬁ x² &Eacute;", "fi x2 e"), ("a\u00a0\u2009b", "a b"), ("&amp;lt;", ""), ("A-b_c.d", "abcd"), (None, None)])
def test_verbatim_form(spark, raw, want):
    assert one(spark, text.normalize_verbatim(F.lit(raw).cast("string"))) == want
    assert raw is None or sql.verbatim_form(raw) == want


@pytest.mark.parametrize(("raw", "want"), [("Data Availability: a <b>x</b>  y", "a x y"), ("data\n availability . z", "z"), ("The data availability", "The data availability"), ("&lt;b&gt;q", "q"), (None, None)])
def test_scored_form(spark, raw, want):
    assert one(spark, text.normalize_scored(F.lit(raw).cast("string"), squeeze=True, availability=True)) == want


@pytest.mark.parametrize(("raw", "want"), [("1A", "A"), ("Fig2B", "B"), ("Panel2E", "E"), ("1A1", "A"), ("a", "A"), ("12", "12"), ("", ""), (None, None)])
def test_panel_label(spark, raw, want):
    assert one(spark, text.panel_label(F.lit(raw).cast("string"))) == want


@pytest.mark.parametrize(("raw", "want"), [("Fig. 3", "Figure 3"), ("Figure S1 2", "Figure 12"), ("Scheme", "Scheme")])
def test_figure_label(spark, raw, want):
    assert one(spark, text.figure_label(F.lit(raw))) == want


@pytest.mark.parametrize(("raw", "want"), [("AB-2024-1/Doc/x.docx", "Doc/x.docx"), ("plain/Doc/x", "plain/Doc/x"), ("a-b/x", "a-b/x"), ("x1-y", "x1-y"), ("a\\b", "a/b")])
def test_clean_path(spark, raw, want):
    assert one(spark, text.clean_path(F.lit(raw))) == want


@pytest.mark.parametrize(("raw", "want"), [("d/", False), ("__MACOSX/a", False), ("a/Thumbs.db", False), (".x", False), ("a/b.csv", True)])
def test_members(spark, raw, want):
    assert one(spark, text.is_data_member(F.lit(raw))) is want


def test_reply_json(spark):
    assert one(spark, text.json_in_reply(F.lit("x ```json\n{\"a\":\n1}``` y {2}"))) == '{"a": 1}'
    assert one(spark, text.json_in_reply(F.lit('so [1, 2] it is'), "[", "]")) == "[1, 2]"
    assert one(spark, text.json_in_reply(F.lit("nothing"))) is None


def test_excerpt_template_and_folding(spark):
    assert one(spark, text.excerpt(F.lit("a  b" + "c" * 200), 10)) == "a bccccccc..."
    assert one(spark, text.excerpt(F.lit("\u00a0a\u2003 b\u00a0"))) == " ".join("\u00a0a\u2003 b\u00a0".split())
    assert one(spark, text.fill_template("$a $ab $x", {"a": F.lit("1"), "ab": F.lit("2")})) == "1 2 $x"
    assert one(spark, text.ascii_fold(F.lit("Å é μm"))) == "A e m"
    assert one(spark, text.drop_empty_items(F.lit("<ul><LI> &nbsp;<br/></li><li>x</li></ul>"))) == "<ul><li>x</li></ul>"


SEQUENCES = [
    (list("ABCDE"), True, list("ABCDE")), (list("ABDE"), False, list("ABCDE")), (list("ace"), False, list("abcde")), (["I", "II", "III"], True, ["I", "II", "III"]), (["I", "III", "II"], True, ["I", "II", "III"]),
    (["I", "III", "V"], False, ["I", "II", "III", "IV", "V"]), (["1", "2", "3"], True, ["1", "2", "3"]), (["1", "3", "5"], False, list("12345")), (["01", "2"], True, ["1", "2"]), (["3", "1"], False, []), (["A"], True, ["A"]),
    ([], False, []), (["B", "A"], False, []), (["AB", "C"], False, list("ABC")), (["?"], False, ["?"]), (["A", "?"], False, ["A", "?"]), (["1", "x"], False, ["1", "x"]), (["I", "IIII"], False, ["I", "IIII"]), (["i", "j"], True, ["i", "j"]),
    (["(A)", "B.", " C"], True, list("ABC")), (["X", "xi"], True, ["X", "XI"]), (["[A]"], False, ["[A]"]),
]


@pytest.mark.parametrize(("labels", "valid", "fixed"), SEQUENCES)
def test_sequences(spark, labels, valid, fixed):
    c = F.array(*[F.lit(x) for x in labels]).cast("array<string>")
    got = one(spark, sequence.verify(sequence.bare_labels(c)))
    assert (got.is_valid, got.fixed_sequence) == (valid, fixed)
    assert got.asDict() == sql.sequence_verdict(labels)
    assert one(spark, sequence.is_sequence(sequence.bare_labels(c))) is valid


def test_what_is_said_of_sequences(spark):
    said = {tuple(x): sql.sequence_verdict(x)["details"] for x, _, _ in SEQUENCES}
    assert said[("A", "B", "D", "E")] == "Sequence has gaps. Fixed sequence: A, B, C, D, E" and said[()] == "No panel labels provided"
    assert said[("I", "IIII")] == "Invalid Roman numeral in sequence: IIII" and said[("A",)] == "Sequence is valid"


def test_functions_that_sql_calls(spark):
    sql.register(spark)
    got = spark.sql("SELECT verify_caption_extraction('Cells <b>grew</b>', 'The cells&nbsp;grew.') AS a, verify_caption_extraction('', 'x') AS b, verify_panel_sequence(array('a', 'c')) AS c, verify_panel_sequence(NULL) AS d").first()
    assert got.a.is_verbatim and not got.b.is_verbatim and got.c.fixed_sequence == ["a", "b", "c"] and not got.d.is_valid


@pytest.mark.parametrize(("roman", "n"), [("IV", 4), ("MCMXCIV", 1994), ("III", 3), ("MMMCMXCIX", 3999), ("MMMMCMXCIX", 4999)])
def test_roman(spark, roman, n):
    assert one(spark, sequence.roman_to_int(F.lit(roman))) == n
    assert one(spark, sequence.int_to_roman(F.lit(n))) == roman
    assert one(spark, sequence.is_roman(F.lit(roman))) is True


def test_not_roman(spark):
    assert one(spark, sequence.is_roman(F.lit("IIII"))) is False
    assert one(spark, sequence.roman_to_int(F.lit("IQ"))) == -1


def test_set_scores(spark):
    s = lambda *x: F.array(*[F.lit(v) for v in x]).cast("array<string>")
    assert one(spark, similarity.jaccard(s(), s())) == 1 and one(spark, similarity.jaccard(s("a"), s())) == 0
    assert one(spark, similarity.jaccard(s("a", "b"), s("b", "c"))) == pytest.approx(1 / 3)
    assert one(spark, similarity.recall(s(), s())) == 1 and one(spark, similarity.recall(s("a"), s())) == 0 and one(spark, similarity.recall(s("a", "a", "b"), s("a"))) == 0.5
    assert one(spark, similarity.positional(s("a", "b"), s("a", "c", "d"))) == 0.5 and one(spark, similarity.positional(s(), s("a"))) == 0


def brute_ratio(a, b):
    """The likeness with every stretch that is as long as the shorter text or stands at an end."""
    if len(a) > len(b):
        a, b = b, a
    n, both = len(a), [(a, b), (b, a)] if len(a) == len(b) else [(a, b)]
    stretches = [(x, y[max(0, i) : i + n]) for x, y in both for i in range(1 - n, len(y)) if n]
    return max((200 * similarity.common_subsequence(x, y) / (len(x) + len(y)) for x, y in stretches if y), default=0)


@pytest.mark.parametrize(("a", "b"), [("abc", "xxabdxx"), ("kitten", "sitting on a mitten"), ("", "x"), ("aaaa", "bbbbbb"), ("hello world", "a hallo, wurld!"), ("abcd", "xxab"), ("abcdefgh", "zzzzabcdef"), ("ab", "ba")])
def test_partial_ratio_is_the_best_of_all_places(a, b):
    assert similarity.partial_ratio(a, b) == pytest.approx(brute_ratio(a, b))


def test_partial_ratio_at_the_ends():
    assert similarity.partial_ratio("abcd", "xxab") == pytest.approx(200 / 3) and similarity.partial_ratio("abcdefgh", "zzzzabcdef") == pytest.approx(1200 / 14)


@given(st.text("abc", max_size=8), st.text("abcd", max_size=12))
def test_partial_ratio_of_any_texts(a, b):
    assert similarity.partial_ratio(a, b) == pytest.approx(100 if a and b and (a in b or b in a) else brute_ratio(a, b))


def test_common_subsequence():
    assert similarity.common_subsequence("abcbdab", "bdcaba") == 4
    assert similarity.common_subsequence([], ["a"]) == 0


def test_overlap_clips_and_keeps_empty_pairs(spark):
    df = spark.createDataFrame([(1, ["a", "a", "b"], ["a", "c"]), (2, [], ["x"]), (3, [], [])], "k int, a array<string>, b array<string>")
    got = {r.k: (r.hits, r.n_a, r.n_b) for r in similarity.overlap(df, "k", "a", "b").collect()}
    assert got == {1: (1, 3, 2), 2: (0, 0, 1), 3: (0, 0, 0)}


@pytest.mark.parametrize(
    ("name", "message", "why", "how"),
    [
        ("BadRequestError", "Maximum context length is 5", "context_length", "recoverable"),
        ("X", "the length limit was reached", "context_length", "recoverable"),
        ("X", "response was truncated", "output_length_limit", "recoverable"),
        ("X", "blocked by content policy", "safety_block", "recoverable"),
        ("RateLimitError", "", "transient_api_error", "recoverable"),
        ("X", "HTTP 503", "transient_api_error", "recoverable"),
        ("NotFoundError", "?", "not_found", "critical"),
        ("X", "?", "unexpected_error", "critical"),
    ],
)
def test_errors(spark, name, message, why, how):
    assert one(spark, errors.reason(F.lit(name), F.lit(message))) == why
    assert one(spark, errors.severity(errors.reason(F.lit(name), F.lit(message)))) == how


def test_overloaded_is_transient_for_one_provider_only(spark):
    why = lambda provider, name, message="": one(spark, errors.reason(F.lit(name), F.lit(message), F.lit(provider)))
    assert why("anthropic", "OverloadedError") == "transient_api_error" and why("openai", "OverloadedError") == "unexpected_error"
    assert why("anthropic", "BadRequestError", "maximum context length") == "invalid_request" and why("openai", "BadRequestError", "maximum context length") == "context_length"


def test_token_details(spark):
    message = "This model's maximum context length is 128,000 tokens. However, you requested 131,072 tokens (130,000 in your prompt; 1,072 for completion)."
    assert tuple(one(spark, errors.token_details(F.lit(message)))) == (128000, 131072, 130000, 1072)
    assert tuple(one(spark, errors.token_details(F.lit("no")))) == (None,) * 4


def test_requested_tokens(spark):
    assert one(spark, errors.requested_tokens(F.lit("you requested 131,072 tokens"))) == 131072
    assert one(spark, errors.requested_tokens(F.lit("no"))) is None
