"""Secrets in texts by a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived
(``trigrams.query_of``). ``build_index`` lists, trigram by trigram, the documents that hold
it; ``candidates`` intersects the postings of each alternative of a query, and unites the
alternatives of a rule. Only candidates are verified with the expression itself; rules
without a mandatory trigram, such as long hexadecimal numbers, scan every text.

The index may hold any trigrams. For a given set of rules it needs just those of their
queries, which keeps it small: other postings would never be read. It is a Parquet table
in ranges of (trigram, document), so a trigram of many documents lies in several tasks and
files, and a query reads the row groups of its trigrams only.

Documents in the index are named by id and a hash of the text. Equal names only make
more candidates: verifying decides. Candidates are few as a rule, and are broadcast if
their counted size allows; otherwise texts and candidates meet in one shuffle by name.

Places are counted in code points, ends are exclusive. Matches of a rule are leftmost and do
not overlap; those of which the told group is shorter than ``least`` are dropped afterwards.

Defined cases: null text is empty and has no secrets; null and repeated ids and repeated
rows are judged by their own text, one result row for each; other columns play no part; an
empty table or no rules give no spans. Only built-in functions are used.
"""

from __future__ import annotations

import json
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklane.llm.trigrams import query_of
from tracklane.operators.skew import bounded_broadcast
from tracklane.session import scratch_path

#: Matches whose places are added up together, so that no text takes a square of its matches.
_TOGETHER = 256
_SPAN = "struct<start:bigint,order:int,end:bigint,kind:string,text:string>"
_RULE = "struct<order:int,kind:string,pattern:string,group:int,least:int,indexed:boolean>"
_CLAUSE = "struct<trigram:string,rule:string,clause:int,bit:bigint,full:bigint>"
_NAME = ("doc_id", "text_key")


@dataclass(frozen=True)
class Rule:
    """Spans of ``kind`` are the matches of ``pattern`` with ``least`` characters in ``group``."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


BASE = (
    Rule(
        "assign",
        r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?"""
        r"([A-Za-z0-9+/_.=-]+)",
        2,
        12,
    ),
    Rule("access", "AKIA[A-Z0-9]+", 0, 18),
    # the runs of 16 and more are just the longest runs that are long enough
    Rule("hex", "[0-9a-f]{16,}"),
)

#: Formats that services give their keys, and the ways in which keys are written down.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("github", r"gh[oprsu]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("stripe", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("bearer", r"(?i:bearer)\x20+[A-Za-z0-9._~+/-]{20,}"),
    Rule("login", r"[a-z]{2,10}://[^\x00-\x20/:@]{1,256}:[^\x00-\x20/@]{1,256}@"),
)


def bind(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), 0)


def _constant(rows: list[dict], kind: str) -> Column:
    return F.from_json(F.lit(json.dumps(rows)), f"array<{kind}>")


def named(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """doc_id, text_key, text (null: empty)."""
    text = F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit(""))
    return docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text")).select(
        "doc_id", F.xxhash64("text").alias("text_key"), "text"
    )


def trigrams_of(rules) -> list[str]:
    """The trigrams that the queries of some rules name."""
    return sorted({t for rule in rules for some in query_of(rule.pattern) for t in some})


def postings(
    docs: DataFrame, trigrams, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """trigram, doc_id, text_key: which documents hold which of the trigrams, in any case."""
    some = F.array(*map(F.lit, trigrams)).cast("array<string>")
    held = bind(F.lower("text"), lambda low: F.filter(some, lambda t: F.contains(low, t)))
    return named(docs, id_col, text_col).select(F.explode(held).alias("trigram"), *_NAME)


def build_index(
    docs: DataFrame, trigrams, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Write the postings of the trigrams below ``path``, in ranges of (trigram, document);
    read them back."""
    found = postings(docs, trigrams, id_col, text_col)
    spark, found_path = docs.sparkSession, f"{path.rstrip('/')}/found"
    # written as found first: cutting ranges reads its input twice, and that must not be texts
    found.write.parquet(found_path)
    written = spark.read.schema(found.schema).parquet(found_path)
    (
        written.repartitionByRange("trigram", *_NAME)
        .sortWithinPartitions("trigram", *_NAME)
        .write.parquet(f"{path.rstrip('/')}/sorted")
    )
    return spark.read.schema(found.schema).parquet(f"{path.rstrip('/')}/sorted")


def _clauses(index: DataFrame, rules) -> tuple[DataFrame | None, list[str]]:
    """(trigram, rule, clause, bit, full) of every alternative, as rows, and the trigrams."""
    rows, asked = [], set()
    for rule in rules:
        for number, some in enumerate(sorted(map(sorted, query_of(rule.pattern)))):
            # a part of the trigrams that are asked for makes more candidates, never fewer
            some = some[:62]
            asked.update(some)
            full = (1 << len(some)) - 1
            rows += [
                {"trigram": t, "rule": rule.kind, "clause": number, "bit": 1 << k, "full": full}
                for k, t in enumerate(some)
            ]
    if not rows:
        return None, []
    one = index.sparkSession.range(1, numPartitions=1)
    return one.select(F.inline(_constant(rows, _CLAUSE))), sorted(asked)


def candidates(index: DataFrame, rules) -> DataFrame:
    """doc_id, text_key, rules: the documents that hold all trigrams of an alternative."""
    clauses, asked = _clauses(index, [r for r in rules if needs_index(r)])
    if clauses is None:
        return index.where("false").select(*_NAME, F.array("trigram").alias("rules"))
    held = (
        index.where(F.col("trigram").isin(asked))
        # as many rows as the rules have trigrams
        .join(F.broadcast(clauses), "trigram")
        .groupBy(*_NAME, "rule", "clause", "full")
        .agg(F.bit_or("bit").alias("bits"))
        .where("bits = full")
    )
    return held.groupBy(*_NAME).agg(F.collect_set("rule").alias("rules"))


def needs_index(rule: Rule) -> bool:
    return all(query_of(rule.pattern))


def _running(sizes: Column) -> Column:
    """Running sums of an array, from 0: in parts, so that no array is copied too often."""

    def sums(numbers: Column) -> Column:
        return F.aggregate(
            numbers,
            F.array(F.lit(0).cast("long")),
            lambda done, n: F.concat(done, F.array(F.element_at(done, -1) + n)),
        )

    parts = F.transform(
        F.sequence(F.lit(0), F.ceil(F.size(sizes) / _TOGETHER).cast("int") - 1),
        lambda k: sums(F.slice(sizes, k * _TOGETHER + 1, _TOGETHER)),
    )

    def put_together(local: Column) -> Column:
        before = sums(F.transform(local, lambda part: F.element_at(part, -1)))
        return bind(
            before,
            lambda starts: F.flatten(
                F.transform(
                    local,
                    lambda part, k: F.transform(
                        F.slice(part, 1, F.size(part) - 1), lambda x: x + F.get(starts, k)
                    ),
                )
            ),
        )

    return bind(parts, put_together)


def _spans(text: Column, rule: Column) -> Column:
    """All matches of a rule with their places, from the lengths of what lies between them."""

    def placed(matches: Column) -> Column:
        between = F.split(text, rule["pattern"], -1)
        # what lies before a match, and the match, in turn
        sizes = F.flatten(
            F.zip_with(
                F.slice(between, 1, F.size(matches)),
                matches,
                lambda gap, match: F.array(F.char_length(gap), F.char_length(match)),
            )
        )

        def rows(at: Column) -> Column:
            def row(match: Column, k: Column) -> Column:
                start = F.get(at, 2 * k + 1)
                return F.struct(
                    start.cast("long").alias("start"),
                    rule["order"].alias("order"),
                    (start + F.char_length(match)).cast("long").alias("end"),
                    rule["kind"].alias("kind"),
                    match.alias("text"),
                )

            return F.transform(matches, row)

        def long_enough(span: Column) -> Column:
            told = F.call_function("regexp_extract", span["text"], rule["pattern"], rule["group"])
            return F.char_length(told) >= rule["least"]

        return F.filter(bind(sizes, lambda n: bind(_running(n), rows)), long_enough)

    return bind(
        F.regexp_extract_all(text, rule["pattern"], F.lit(0)),
        lambda m: F.when(F.size(m) > 0, placed(m)).otherwise(F.array().cast(f"array<{_SPAN}>")),
    )


def scan(
    docs: DataFrame,
    rules=BASE + MORE,
    index: DataFrame | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """doc_id, spans: for every row its secrets as structs (start, order, end, kind, text),
    by start and then in the order of the rules.

    ``index`` holds at least the trigrams of the rules' queries for these documents; without
    it one is built in the shared folder.
    """
    rules = list(rules)
    if index is None:
        path = scratch_path(docs.sparkSession, "trigrams")
        index = build_index(docs, trigrams_of(rules), path, id_col, text_col)
    likely = bounded_broadcast(candidates(index, rules))
    rows = named(docs, id_col, text_col)
    same = rows.doc_id.eqNullSafe(likely.doc_id) & (rows.text_key == likely.text_key)
    joined = rows.join(likely, same, "left").select(rows.doc_id, "text", "rules")
    every = [
        {"order": i, "indexed": needs_index(rule), **asdict(rule)} for i, rule in enumerate(rules)
    ]
    # only the index decides whether a rule with mandatory trigrams is looked for
    asked = F.filter(
        _constant(every, _RULE),
        lambda r: ~r["indexed"] | F.array_contains(F.coalesce("rules", F.array()), r["kind"]),
    )
    spans = F.flatten(F.transform(asked, lambda r: _spans(F.col("text"), r)))
    return joined.select("doc_id", F.sort_array(spans).alias("spans"))


def written(spans: Column) -> Column:
    """kind:start:end of spans, comma-joined."""
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
