"""License scan: ordered signature rules over whole texts, in Spark expressions only.

A text is lower-cased (A-Z) and cut into words. The words are looked up among the anchor words of the
rules; only texts that have one are matched, and only against the rules whose keyword they
contain. Each match is a detection with its place in words. The detections that lie within no other (of equal
places that of the later rule lies within) are taken in the order of the rules, and each stays that overlaps none
that stays; then the same is done with those left that overlap none. So nothing goes for one that goes itself.
Base phrases are reported in all their places whatever the rules find.

Null and empty texts have no words and no detection. A text may have any length: repeated groups in rules are
possessive, as the regular expressions would else recurse once for each repetition. Rows that repeat an id are scanned
as rows of their own; an empty table gives no rows. Columns other than the two named are ignored.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeline.llm.license_rules import Rule, base_rules, rules
from lakeline.sources.files import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
HITS = "array<struct<first:int,last:int,number:int>>"


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" "), F.lit("")))


def _rule_table(rules: list[Rule]) -> Column:
    return F.array(*[
        F.struct(
            F.array(*map(F.lit, rule.anchors)).alias("anchors"), F.lit(rule.keyword).alias("keyword"),
            F.lit(f"(?<= )(?:{rule.pattern})(?= )").alias("pattern"), F.lit(rule.number).alias("number"),
        ) for rule in rules
    ])


def _places(rule: Column) -> Column:
    """All matches of a rule: first and last word. Matches and the text between them add up."""
    found = F.call_function("regexp_extract_all", F.col("line"), rule["pattern"], F.lit(0))
    between = F.call_function("split", F.col("line"), rule["pattern"], F.lit(-1))
    start = F.struct(F.lit(-1).alias("words"), F.expr(f"CAST(array() AS {HITS})").alias("hits"))

    def step(state: Column, pair: Column) -> Column:
        first = state["words"] + _spaces(pair["between"])
        last = first + _spaces(pair["found"])
        hit = F.struct(first.alias("first"), last.alias("last"), rule["number"].alias("number"))
        return F.struct(last.alias("words"), F.concat(state["hits"], F.array(hit)).alias("hits"))

    pairs = F.arrays_zip(between.alias("between"), found.alias("found"))
    matched = F.filter(pairs, lambda pair: pair["found"].isNotNull())
    return F.aggregate(matched, start, step, lambda state: state["hits"])


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` worked out once; an expression named twice would be worked out twice."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _overlap(one: Column, other: Column) -> Column:
    return (one["first"] <= other["last"]) & (other["first"] <= one["last"])


def _chosen(chain: Column) -> Column:
    """What stays of detections that overlap in a chain, sorted by first place, longest first, then rule."""
    nothing = F.expr(f"CAST(array() AS {HITS})")

    def outer(hits: Column) -> Column:
        start = F.struct(F.lit(-1).alias("reach"), nothing.alias("found"))
        return F.aggregate(hits, start, lambda state, hit: F.when(
            hit["last"] <= state["reach"], state).otherwise(F.struct(
                hit["last"].alias("reach"), F.concat(state["found"], F.array(hit)).alias("found"))),
            lambda state: state["found"])

    def by_rule(hits: Column) -> Column:
        return F.array_sort(F.transform(hits, lambda hit: F.struct(
            hit["number"].alias("rule"), hit["first"].alias("first"), hit["last"].alias("last"), hit["number"].alias("number"))))

    def layer(state: Column, _: Column) -> Column:
        kept = F.aggregate(by_rule(outer(state["left"])), state["kept"], lambda kept, hit: F.when(
            F.exists(kept, lambda other: _overlap(hit, other)), kept).otherwise(F.concat(kept, F.array(F.struct(
                hit["first"].alias("first"), hit["last"].alias("last"), hit["number"].alias("number"))))))
        return F.when(F.size(state["left"]) == 0, state).otherwise(_let(kept, lambda now: F.struct(F.filter(
            state["left"], lambda hit: ~F.exists(now, lambda other: _overlap(hit, other))).alias("left"), now.alias("kept"))))

    layers = F.aggregate(F.sequence(F.lit(1), F.size(chain)), F.struct(
        chain.alias("left"), nothing.alias("kept")), layer, lambda state: state["kept"])
    return F.when(F.size(chain) < 2, chain).otherwise(layers)


def _resolved(hits: Column) -> Column:
    """Of the detections in no other, by rule, those that overlap none that stays; then the same with what is left.

    Only what stays drives others out. Chains of overlapping detections are resolved one by one, so
    a text's number of detections does not matter, only how many overlap.
    """
    def order(one: Column, other: Column) -> Column:
        keys = [(one["first"], other["first"]), (other["last"], one["last"]), (one["number"], other["number"])]
        result = F.lit(0)
        for a, b in reversed(keys):
            result = F.when(a < b, -1).when(a > b, 1).otherwise(result)
        return result

    nothing = F.expr(f"CAST(array() AS {HITS})")
    start = F.struct(F.lit(-1).alias("reach"), nothing.alias("chain"), nothing.alias("kept"))

    def step(state: Column, hit: Column) -> Column:
        return F.when(hit["first"] > state["reach"], F.struct(
            hit["last"].alias("reach"), F.array(hit).alias("chain"),
            F.concat(state["kept"], _chosen(state["chain"])).alias("kept"))).otherwise(F.struct(
                F.greatest(state["reach"], hit["last"]).alias("reach"),
                F.concat(state["chain"], F.array(hit)).alias("chain"), state["kept"].alias("kept")))

    resolved = F.aggregate(F.array_sort(hits, order), start, step,
                           lambda state: F.concat(state["kept"], _chosen(state["chain"])))
    return F.when(F.size(hits) < 2, hits).otherwise(F.array_sort(resolved))


def _joined(labels: Column) -> Column:
    return F.array_join(F.array_sort(F.array_distinct(labels)), ",")


def scan(docs: DataFrame, extra: list[Rule] | None = None) -> DataFrame:
    """Detections of each row of ``docs (doc_id, text)``.

    ``doc_id, n_words, base`` and ``detections`` (arrays of first and last word and rule number),
    ``base_labels, labels`` and ``score``: the chance that at least one detection is right.
    """
    base, signatures = base_rules(), rules() if extra is None else extra
    every = base + signatures
    anchors = F.array(*[F.lit(word) for word in sorted({a for rule in every for a in rule.anchors})])
    table_of = _rule_table(every)
    labels = F.array(*[F.lit(rule.label) for rule in every])
    misses = F.array(*[F.lit(1.0 - rule.strength) for rule in every])
    lowered = F.translate(F.coalesce(F.col("text").cast("string"), F.lit("")), UPPER, LOWER)
    plain = docs.select("doc_id", F.trim(F.regexp_replace(lowered, BETWEEN, " ")).alias("plain"))
    anchored = plain.select(
        "doc_id", "plain", F.array_intersect(F.split("plain", " "), anchors).alias("anchors"))
    lines = anchored.select(
        "doc_id", "anchors",
        F.when(F.col("plain") == "", 0).otherwise(_spaces(F.col("plain")) + 1).cast("bigint").alias("n_words"),
        F.when(F.size("anchors") > 0, F.concat(F.lit(" "), "plain", F.lit(" "))).alias("line"),
    )
    tried = F.filter(table_of, lambda rule: F.arrays_overlap(rule["anchors"], "anchors")
                     & F.contains(F.col("line"), rule["keyword"]))
    hits = lines.select("doc_id", "n_words", F.coalesce(
        F.when(F.col("line").isNotNull(), F.flatten(F.transform(tried, _places))),
        F.expr(f"CAST(array() AS {HITS})")).alias("hits"))
    parted = hits.select(
        "doc_id", "n_words",
        F.filter("hits", lambda hit: hit["number"] < len(base)).alias("base"),
        _resolved(F.filter("hits", lambda hit: hit["number"] >= len(base))).alias("detections"),
    )
    named = lambda found: F.transform(found, lambda hit: F.get(labels, hit["number"]))
    both = F.concat("base", "detections")
    missed = F.aggregate(F.array_distinct(F.transform(both, lambda hit: hit["number"])), F.lit(1.0),
                         lambda left, number: left * F.get(misses, number))
    return parted.select(
        "doc_id", "n_words", "base", "detections", _joined(named("base")).alias("base_labels"),
        _joined(F.concat(named("base"), named("detections"))).alias("labels"),
        (F.lit(1.0) - missed).alias("score"),
    )


def op1_licenses(spark: SparkSession, folder: str) -> DataFrame:
    """License detections of every document."""
    found = scan(table(spark, folder, "documents", "doc_id", "text"))
    firsts = F.transform("base", lambda hit: hit["first"].cast("bigint"))
    return found.select(
        "doc_id", "n_words", F.size("base").cast("bigint").alias("n_base"),
        F.array_min(firsts).alias("first_word"), F.array_max(firsts).alias("last_word"),
        "base_labels", "labels", "score",
    )
