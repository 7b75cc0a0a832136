"""Secret scans over a trigram inverted index, with DataFrame functions alone.

Each rule's regex is turned into a Boolean trigram query: some alternatives,
each a set of trigrams that a match must hold in lower case. Postings (trigram,
doc_id) are built for the trigrams that any rule asks for, and intersected: a
document is a candidate of a rule when it holds all trigrams of one alternative.
Only candidates are verified with the regex. A rule without mandatory trigrams
(a run of hexadecimal digits) scans every text.

Defined results: null and empty texts hold nothing; a null id, or several rows of
one id, share their candidates and are verified row by row, so each row has the
spans of its own text; columns beside doc_id and text are passed on untouched;
texts are scanned whole, whatever their length. Places count code points.
"""

from __future__ import annotations

import re._parser as regex_parser
from itertools import product
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigil.llm.common import table, with_row


class Rule(NamedTuple):
    """A kind of secret. group and least: the match counts if that group has so many characters."""

    kind: str
    regex: str
    group: int = 0
    least: int = 1


#: The three base kinds, then those that the scan adds. A run is taken whole or not at all, so the
#: least length of access and hex stands in the regex; the value of assign is judged after the match, which it ends.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: A private key with its END line, or else its base64 block: long runs, and a last short line. Line ends may be written out.
#: Repeated groups take all they can and give nothing back (*+), which Java's matcher does in a loop and not by recursion.
HEADER = r"-----BEGIN (?:[A-Z]{2,10} ){0,2}PRIVATE KEY-----"
TO_END = r"(?:[^-]+|-{1,4}[^-])*+-----END (?:[A-Z]{2,10} ){0,2}PRIVATE KEY-----"
ARMOUR = r"(?:[\x20\t\r\n]*(?:Proc-Type|DEK-Info):[^\n]*)*+"
BLOCK = ARMOUR + r"(?:[\x20\t\r\n\\rn]*[A-Za-z0-9+/=]{16,})*+(?:[\r\n]+[A-Za-z0-9+/]{1,15}={0,2}(?m:$))?"
ADDED = (
    Rule("forge_token", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_token", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("private_key", HEADER + "(?:" + TO_END + "|" + BLOCK + ")"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
RULES = BASE + ADDED
MARK = "[SECRET]"


def exact_strings(node, most: int = 64) -> set[str] | None:
    """All lower-cased strings that a parsed piece can match, or None if they are many or without bound."""
    kind, value = str(node[0]), node[1]
    if kind == "LITERAL":
        return {chr(value).lower()}
    if kind == "IN":
        chars = set()
        for k, v in value:
            if str(k) == "LITERAL":
                chars.add(chr(v).lower())
            elif str(k) == "RANGE" and v[1] - v[0] < 8:
                chars |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
            else:
                return None
        return chars if len(chars) <= 8 else None
    if kind == "SUBPATTERN":
        return exact_sequence(value[-1], most)
    if kind == "BRANCH":
        parts = [exact_sequence(x, most) for x in value[1]]
        return None if None in parts else set().union(*parts)
    if kind == "MAX_REPEAT" and value[1] == 1:
        inner = exact_sequence(value[2], most)
        return inner and (inner if value[0] else inner | {""})
    return None


def exact_sequence(nodes, most: int) -> set[str] | None:
    found = {""}
    for node in nodes:
        more = exact_strings(node, most)
        if more is None or len(found) * len(more) > most:
            return None
        found = {a + b for a in found for b in more}
    return found


def trigram_query(pattern: str, most: int = 64) -> list[frozenset[str]] | None:
    """Alternatives of which a match holds one whole; None if no trigram is mandatory."""
    runs, run = [], {""}
    for node in regex_parser.parse(pattern):
        more = exact_strings(node, most)
        if more is not None and len(run) * len(more) <= most:
            run = {a + b for a in run for b in more}
        else:
            runs.append(run)
            run = {""} if more is None else more
    query = [frozenset()]
    for run in sorted([*runs, run], key=len):
        if all(len(x) >= 3 for x in run) and len(query) * len(run) <= most:
            query = [a | {x[i : i + 3] for i in range(len(x) - 2)} for a, x in product(query, run)]
    return list(dict.fromkeys(query)) if all(query) else None


def trigram_postings(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """(trigram, doc_id) for those of the trigrams that a text holds in lower case."""
    lowered = docs.select("doc_id", F.lower("text").alias("low"))  # a column below the generator: once, not for each trigram
    return lowered.select("doc_id", F.explode(F.filter(F.array(*map(F.lit, trigrams)), lambda t: F.contains(F.col("low"), t))).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, kinds): the rules with trigram queries that the postings leave open for each document."""
    asked = [(r.kind, i, len(a), t) for r in rules for i, a in enumerate(trigram_query(r.regex) or ()) for t in sorted(a)]
    terms = docs.sparkSession.createDataFrame(asked, "kind string, alternative int, need int, trigram string")
    postings = trigram_postings(docs, sorted({t for *_, t in asked}))
    # a fixed table of a few hundred rows: the rules, not the data, set its size
    held = postings.join(F.broadcast(terms), "trigram").groupBy("doc_id", "kind", "alternative", "need").agg(F.count_distinct("trigram").alias("held"))
    return held.filter("held = need").groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """The rule's counted matches as (start, stop, order, kind): text between matches and matches give the places."""
    pattern = F.lit(rule.regex)
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    judged = F.regexp_extract_all(text, pattern, F.lit(rule.group)) if rule.group else found
    between = F.split(text, rule.regex, -1)
    lengths = F.zip_with(between, found, lambda a, b: F.struct(F.length(a).alias("gap"), F.coalesce(F.length(b), F.lit(-1)).alias("size")))
    start = F.struct(F.lit(0).alias("at"), F.expr("cast(array() as array<struct<start:int,stop:int>>)").alias("all"))

    def step(acc, x):
        begin = acc["at"] + x["gap"]
        return F.struct((begin + x["size"]).alias("at"), F.concat(acc["all"], F.array(F.struct(begin.alias("start"), (begin + x["size"]).alias("stop")))).alias("all"))

    placed = F.aggregate(F.filter(lengths, lambda x: x["size"] >= 0), start, step, lambda acc: acc["all"])
    kept = F.filter(F.arrays_zip(placed.alias("p"), judged.alias("j")), lambda x: F.length(x["j"]) >= rule.least)
    return F.transform(kept, lambda x: F.struct(x["p"]["start"].alias("start"), x["p"]["stop"].alias("stop"), F.lit(order).alias("order"), F.lit(rule.kind).alias("kind")))


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with __spans: (start, stop, order, kind) of every secret, by start and then by order of the rules. A column of that name is replaced."""
    docs, text = docs.drop("__spans", "__doc_id", "__kinds"), F.coalesce("text", F.lit(""))
    none = F.expr("cast(array() as array<struct<start:int,stop:int,order:int,kind:string>>)")
    opened = candidates(docs.select("doc_id", "text"), rules).withColumnsRenamed({"doc_id": "__doc_id", "kinds": "__kinds"})
    joined = docs.join(opened, F.col("doc_id").eqNullSafe(F.col("__doc_id")), "left")
    found = []
    for order, rule in enumerate(rules):
        full = trigram_query(rule.regex) is None
        test = text.rlike(rule.regex) if full else F.coalesce(F.array_contains("__kinds", rule.kind), F.lit(False))
        found.append(F.when(test, rule_spans(text, rule, order)).otherwise(none))
    return joined.withColumn("__spans", F.array_sort(F.concat(*found))).drop("__doc_id", "__kinds")


def joined_spans(spans: Column) -> Column:
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["stop"].cast("string"))), ",")


def redact(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """docs with every secret in text replaced by a mark; overlapping secrets share one. n_chars follows, if there."""
    begin = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))
    text = F.col("text")

    def step(acc, x):
        gap = F.substring(text, acc["at"] + 1, x["start"] - acc["at"])
        fresh = F.struct(x["stop"].alias("at"), F.concat(acc["out"], gap, F.lit(MARK)).alias("out"))
        longer = F.struct(F.greatest(acc["at"], x["stop"]).alias("at"), acc["out"].alias("out"))
        return F.when(x["start"] >= acc["at"], fresh).otherwise(longer)

    whole = F.aggregate("__spans", begin, step, lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text))))
    cleaned = scan(with_row(docs, "doc_id", "text"), rules).withColumn("text", F.when(F.size("__spans") > 0, whole).otherwise(text))
    fresh = {"text": F.col("text")} | ({"n_chars": F.length("text").cast(docs.schema["n_chars"].dataType)} if "n_chars" in docs.columns else {})
    return cleaned.select(*(fresh.get(x, F.col("__row").getField(x)).alias(x) for x in docs.columns))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("__spans", lambda x: x["order"] < len(BASE))
    counts = [F.size(F.filter(F.transform("__spans", lambda x: x["kind"]), F.lit(r.kind).eqNullSafe)).cast("long").alias(f"n_{r.kind}") for r in BASE]
    return found.select("doc_id", *counts, F.sha2(joined_spans(base), 256).alias("base_sha256"), joined_spans(F.col("__spans")).alias("spans"))


def scan_sql(rules: tuple[Rule, ...] = RULES) -> str:
    """The same spans in DuckDB SQL: one CTE has matches and gaps of each rule, the next the places."""
    regex = [r.regex.replace("'", "''").replace("*+", "*") for r in rules]  # its matcher never recurses
    parts = ", ".join(f"regexp_extract_all(text, '{x}') AS m{o}, regexp_extract_all(text, '{x}', {r.group}) AS j{o}, string_split_regex(text, '{x}') AS p{o}" for o, (r, x) in enumerate(zip(rules, regex, strict=True)))
    placed = " || ".join(
        f"""list_filter(list_transform(range(1, len(m{o}) + 1), lambda i: {{
          'start': (coalesce(list_sum(list_transform(p{o}[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(m{o}[1:i - 1], lambda x: length(x))), 0))::BIGINT,
          'ord': {o}, 'size': length(m{o}[i]), 'kind': '{r.kind}', 'judged': length(j{o}[i])}}), lambda s: s.judged >= {r.least})"""
        for o, r in enumerate(rules)
    )
    text = "list_transform({0}, lambda s: s.kind || ':' || s.start || ':' || (s.start + s.size))"
    base = f"list_filter(spans, lambda s: s.ord < {len(BASE)})"
    counts = ", ".join(f"len(list_filter(spans, lambda s: s.ord = {o}))::BIGINT AS n_{r.kind}" for o, r in enumerate(BASE))
    return f"""
    WITH texts AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
    parts AS (SELECT doc_id, {parts} FROM texts),
    found AS (SELECT doc_id, list_sort({placed}) AS spans FROM parts)
    SELECT doc_id, {counts}, sha256(array_to_string({text.format(base)}, ',')) AS base_sha256,
           array_to_string({text.format("spans")}, ',') AS spans
    FROM found"""


OP2_SQL = scan_sql()
