"""Keyword matching: literal ASCII-case-insensitive substrings and unescaped regexes."""

from labormart.operators.skills import regex_skill_counts, row_skills, skill_counts, top_skills
from labormart.schema import LITERAL_SKILLS, REGEX_SKILLS


def _df(spark, texts):
    return spark.createDataFrame([(t,) for t in texts], "snippet_requirement STRING")


def test_literal_substring_semantics(spark):
    df = _df(spark, ["MongoDB and JavaScript", "abc", "PYTHON, python", None])
    got = {r.skill: r["count"] for r in skill_counts(df).collect()}
    assert got["Go"] == 1 and got["MongoDB"] == 1      # "Go" matches "MongoDB"
    assert got["Java"] == 1 and got["JavaScript"] == 1  # "Java" matches "JavaScript"
    assert got["Python"] == 1                           # a row counts once
    assert "C++" not in got                             # literal: "abc" has no "c++"
    assert len(LITERAL_SKILLS) == 33 and len(REGEX_SKILLS) == 22


def test_ascii_only_case_folding(spark):
    # Non-ASCII upper case letters are left as they are.
    df = _df(spark, ["ДОКЕР Docker", "PYTHÖN"])
    got = {r.skill: r["count"] for r in skill_counts(df).collect()}
    assert got == {"Docker": 1}


def test_regex_unescaped(spark):
    df = _df(spark, ["abc", "Go developer", "nothing here"])
    got = {r.skill: r["count"] for r in regex_skill_counts(df).collect()}
    assert got["C++"] == 1            # unescaped C++ means "contains c"
    assert got["Go"] == 1
    assert all(v > 0 for v in got.values())


def test_top_n_ties_by_name(spark):
    df = _df(spark, ["Rust Kafka", "Rust Kafka Redis"])
    rows = top_skills(df, n=2).collect()
    assert [(r.skill, r["count"]) for r in rows] == [("Kafka", 2), ("Rust", 2)]


def test_row_skills_and_array_mode(spark):
    df = row_skills(_df(spark, ["Docker, Kubernetes", "none"]))
    assert df.collect()[0].skills == ["Docker", "Kubernetes"]
    got = {r.skill: r["count"] for r in skill_counts(df, "skills", mode="array").collect()}
    assert got == {"Docker": 1, "Kubernetes": 1}


def test_letters_match_their_simple_foldings_only(spark):
    """Of all characters of the basic plane, an ASCII letter matches itself in both cases, s the long s
    and k the Kelvin sign: no dotless or dotted i. The literal form and the regex form agree."""
    from pyspark.sql import functions as F

    from labormart.functions import regex_ci, unicode_fold

    cps = [c for c in range(0x10000) if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(chr(c),) for c in cps], "t STRING").repartition(4).cache()
    signs = "abcdefghijklmnopqrstuvwxyz0123456789"
    extra = {"s": "\u017f", "k": "\u212a"}
    for test in (lambda ch: unicode_fold("t").contains(ch), lambda ch: regex_ci("t", ch)):
        got = df.agg(*[F.array_sort(F.collect_set(F.when(test(ch), F.col("t")))).alias(f"c{i}") for i, ch in enumerate(signs)]).first()
        assert [set(x) for x in got] == [{ch, ch.upper(), *extra.get(ch, "")} for ch in signs]
    df.unpersist()


def test_regex_fast_path_matches_regex_engine(spark):
    from pyspark.sql import functions as F

    from labormart.functions import regex_ci

    texts = ["\u017fql and Po\u017ftgreSQL", "\u212aUBERNETES on Kafka", "g\u0131t and G\u0130T", "plain c", "ß", "",
             "Go/Rust/REST"]
    df = _df(spark, texts)
    fast = {r.skill: r["count"] for r in regex_skill_counts(df).collect()}
    slow = df.agg(*[F.count_if(regex_ci("snippet_requirement", k)).alias(k) for k in REGEX_SKILLS]).first().asDict()
    assert fast == {k: v for k, v in slow.items() if v > 0}
    assert "Git" not in fast and fast["SQL"] == 1 and fast["Kubernetes"] == 1


def test_regex_with_an_operator_and_odd_letters(spark):
    from labormart.functions import regex_ci

    df = _df(spark, ["DO\u0130T", "doit", "do\u0131t", "d\u0131t", "ДОМ", "дом"])
    found = lambda p: [r.snippet_requirement for r in df.where(regex_ci("snippet_requirement", p)).collect()]
    assert found("do+it") == ["doit"] and found("d(o)?\u0131t") == ["do\u0131t", "d\u0131t"] and found("до(м|х)") == ["ДОМ", "дом"]
