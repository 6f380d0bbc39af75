"""Secret scans behind a trigram inverted index, in DataFrame functions only.

Each rule's regular expression is turned into a Boolean query of trigrams. The
index holds, for every document, postings of those trigrams that some rule can ask
for, so its vocabulary is bounded by the rules. Postings are joined with the
queries' terms and intersected by document; only documents that satisfy a rule's
query are searched with its expression. A rule without mandatory trigrams
searches all documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cityscan.llm.common import literal_table, shared_table, with_ids
from cityscan.llm.trigrams import trigram_query


def either_case(words: str) -> str:
    """A pattern in which each ASCII letter stands for both its cases."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


@dataclass(frozen=True)
class Rule:
    """Leftmost non-overlapping matches of ``pattern``; those whose ``group`` has fewer than
    ``least`` characters are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


#: Fixed values. For access and hex, a run is matched whole, so a least length in the
#: pattern drops the same matches as a test afterwards.
BASE_RULES = (
    Rule("assign", "(" + "|".join(map(either_case, ("password", "passwd", "secret", "token", "api_?key"))) + ")"
         + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("github", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", "AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", "sk_live_[A-Za-z0-9]{24,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
    Rule("pem", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)
RULES = BASE_RULES + MORE_RULES

_KEY = "__secret_key"
_RULES = "__secret_rules"


def postings(docs: DataFrame, vocabulary: list[str], text: str = "text") -> DataFrame:
    """``(key, trigram)``: which of ``vocabulary`` each document's lower-cased text holds."""
    low = F.lower(F.coalesce(F.col(text), F.lit("")))
    held = F.filter(F.array(*map(F.lit, vocabulary)), lambda t: F.contains(F.col("__low"), t))
    return docs.select(_KEY, low.alias("__low")).select(_KEY, F.explode_outer(held).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...], text: str = "text") -> DataFrame:
    """``(key, rules)``: the rules whose trigram query a document satisfies."""
    terms = [(t, i, j, 1 << p) for i, r in enumerate(rules) for j, conj in enumerate(trigram_query(r.pattern) or [])
             for p, t in enumerate(sorted(conj))]
    full = [(i, j, (1 << len(conj)) - 1) for i, r in enumerate(rules)
            for j, conj in enumerate(trigram_query(r.pattern) or [])]
    spark = docs.sparkSession
    terms_df = literal_table(spark, terms, "trigram string, rule int, part int, bit long")
    full_df = literal_table(spark, full, "rule int, part int, all long")
    hits = (postings(docs, sorted({t[0] for t in terms}), text).join(F.broadcast(terms_df), "trigram")
            .groupBy(_KEY, "rule", "part").agg(F.bit_or("bit").alias("bits"))
            .join(F.broadcast(full_df), ["rule", "part"]).where("bits = all"))
    return hits.groupBy(_KEY).agg(F.collect_set("rule").alias(_RULES))


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """The rule's spans in ``text`` as structs (start, order, end, kind), code points, end exclusive.

    What lies between the matches gives their places: the text split at the matches.
    """
    pattern = F.lit(rule.pattern)
    pieces = F.split(text, rule.pattern, -1)
    found = F.arrays_zip(
        F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), lambda m: F.length(m)).alias("n"),
        F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), lambda m: F.length(m)).alias("g"),
        F.transform(F.slice(pieces, F.lit(1), F.size(pieces) - 1), lambda p: F.length(p)).alias("gap"))
    empty = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")

    def step(acc, x):
        start = acc["at"] + x["gap"]
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), (start + x["n"]).alias("end"),
                        F.lit(rule.kind).alias("kind"))
        kept = F.when(x["g"] >= rule.least, F.array_append(acc["out"], span)).otherwise(acc["out"])
        return F.struct((start + x["n"]).alias("at"), kept.alias("out"))

    spans = F.aggregate(found, F.struct(F.lit(0).alias("at"), empty.alias("out")), step, lambda acc: acc["out"])
    return F.when(F.rlike(text, pattern), spans).otherwise(empty)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, doc_id: str = "doc_id", text: str = "text",
         out: str = "spans") -> DataFrame:
    """``docs`` with ``out``: all spans in order of start, then of the rules.

    A null or empty text has none. Rows that share an id are searched each for
    itself. A column named ``out`` is replaced; no other column is touched.
    """
    kept = [F.col(c) for c in docs.columns if c != out]
    docs = docs.withColumn(_KEY, F.xxhash64(doc_id))
    indexed = [i for i, r in enumerate(rules) if trigram_query(r.pattern)]
    if indexed:
        found = shared_table(candidates(docs, rules, text), "secret-candidates")
        docs = with_ids(docs, found, _KEY, "left")
    body = F.coalesce(F.col(text), F.lit(""))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    spans = []
    for i, r in enumerate(rules):
        s = rule_spans(body, r, i)
        spans.append(F.when(F.array_contains(_RULES, i), s).otherwise(none) if i in indexed else s)
    return docs.select(*kept, F.array_sort(F.concat(*spans)).alias(out))


def redact(text: Column, spans: Column, mark: str = "[secret]") -> Column:
    """``text`` with every run of overlapping spans replaced by ``mark``; null stays null."""

    def step(acc, s):
        fresh = s["start"] >= acc["at"]
        gap = F.substring(text, acc["at"] + 1, F.greatest(F.lit(0), s["start"] - acc["at"]))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"),
                        F.when(fresh, F.concat(acc["out"], gap, F.lit(mark))).otherwise(acc["out"]).alias("out"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    rest = F.length(text)
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(
        spans, start, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, rest))))


def count(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda s: s["kind"] == kind)).cast("long")


def digest(spans: Column, kinds: tuple[str, ...]) -> Column:
    """kind:start:end of the spans of ``kinds``, comma-joined."""
    chosen = F.filter(spans, lambda s: s["kind"].isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


# ---------------------------------------------------------------- the same in DuckDB SQL


def _sql_rule(rule: Rule, order: int) -> str:
    p = "'" + rule.pattern.replace("'", "''") + "'"
    return f"""list_filter(list_transform(range(1, len(regexp_extract_all(t, {p})) + 1), lambda i: {{
        'start': (list_sum(list_transform(string_split_regex(t, {p})[1:i], lambda x: length(x)))
                  + coalesce(list_sum(list_transform(regexp_extract_all(t, {p})[1:i-1], lambda x: length(x))), 0))::BIGINT,
        'ord': {order}, 'n': length(regexp_extract_all(t, {p})[i]), 'kind': '{rule.kind}',
        'g': length(regexp_extract_all(t, {p}, {rule.group})[i])}}), lambda s: s.g >= {rule.least})"""


def oracle_sql(rules: tuple[Rule, ...] = RULES, base: int = len(BASE_RULES)) -> str:
    all_spans = "list_concat(" * (len(rules) - 1) + _sql_rule(rules[0], 0) + "".join(
        f", {_sql_rule(r, i)})" for i, r in enumerate(rules) if i)
    joined = "array_to_string(list_transform({}, lambda s: s.kind || ':' || s.start || ':' || (s.start + s.n)), ',')"
    count = ", ".join(f"len(list_filter(spans, lambda s: s.ord = {i}))::BIGINT AS n_{r.kind}" for i, r in enumerate(rules[:base]))
    return f"""
      SELECT doc_id, {count},
             sha256({joined.format(f'list_filter(spans, lambda s: s.ord < {base})')}) AS base_sha256,
             {joined.format('spans')} AS spans
      FROM (SELECT doc_id, list_sort({all_spans}) AS spans
            FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents))"""
