"""License scans: ordered signature rules over the words of whole texts, in Spark expressions only.

A text is read in ASCII lower case as words of letters, digits and non-ASCII
characters (``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``).  Rules (``license_rules``) are
regular expressions that begin at an anchor word.  Only at anchor words are
rules looked at, only those of that anchor, and of them only those whose fixed
part stands in the words that follow; so most texts and places cost one hash
lookup a word.

Overlapping detections: one is suppressed if another contains its interval of
words and has a higher priority, or an equal priority and a longer interval or
the same interval and an earlier rule.  A running maximum of interval ends per
priority, in order of starts, decides that in one pass.  Base phrases are all
counted, whatever contains them.

Defined results: a null or empty text has no words and no detections (labels are
the empty string, places null, score 0); every input row gives one row, repeated
rows and null keys too; an empty table gives an empty table.  Columns other than
key and text are not read.
"""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from . import license_rules

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
_RULE = "struct<label:string,priority:int,number:int,base:boolean,needs:string,pattern:string,confidence:double>"
_PRIORITIES = (license_rules.BARE, license_rules.NAMED, license_rules.NOTICE, license_rules.TAG)


def ascii_lower(text: Column) -> Column:
    """A-Z in lower case and no other character turned into an ASCII letter (KELVIN SIGN, I WITH DOT ABOVE)."""
    safe = F.replace(F.replace(text, F.lit("K"), F.lit("ǝ")), F.lit("İ"), F.lit("ı"))
    return F.lower(safe)


def _rule_map(rules: list[license_rules.Rule]) -> Column:
    """Rules by anchor, as one literal."""
    by: dict[str, list[dict]] = {}
    for number, r in enumerate(rules):
        by.setdefault(r.anchor, []).append({
            "label": r.label, "priority": r.priority, "number": number, "base": r.base, "needs": r.needs,
            "pattern": f"^({r.pattern})(?= |$)", "confidence": license_rules.CONFIDENCE[r.priority]})
    return F.from_json(F.lit(json.dumps(by)), f"map<string,array<{_RULE}>>")


def detections(docs: DataFrame, rules: list[license_rules.Rule] | None = None, key: str = "doc_id",
               text: str = "text") -> DataFrame:
    """One row per detection, and one of nulls per row without any: (row, key, n_words, d).

    ``row`` numbers the input rows; ``d`` has label, priority, number, base,
    confidence, start and end (words from 0, end exclusive).
    """
    rules = license_rules.rules() if rules is None else rules
    anchors = sorted({r.anchor for r in rules})
    words = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(key).alias("key"),
        F.regexp_extract_all(ascii_lower(F.coalesce(F.col(text).cast("string"), F.lit(""))), F.lit(WORD), F.lit(0)).alias("w"))
    places = F.filter(F.transform("w", lambda x, i: F.when(x.isin(anchors), i)), lambda i: i.isNotNull())
    windows = F.transform(places, lambda i: F.struct(
        i.alias("start"), F.get(F.col("w"), i).alias("anchor"),
        F.concat_ws(" ", F.slice("w", i + 1, license_rules.WINDOW_WORDS)).alias("window")))
    seen = words.select("row", "key", F.size("w").cast("long").alias("n_words"), windows.alias("windows"))
    known = _rule_map(rules)

    def matches(place: Column) -> Column:
        near = F.filter(F.element_at(known, place["anchor"]), lambda r: F.contains(place["window"], r["needs"]))
        tried = F.transform(near, lambda r: F.struct(
            r["label"].alias("label"), r["priority"].alias("priority"), r["number"].alias("number"), r["base"].alias("base"),
            r["confidence"].alias("confidence"), place["start"].cast("long").alias("start"),
            F.regexp_extract_all(place["window"], r["pattern"], F.lit(1)).alias("found")))
        return F.transform(F.filter(tried, lambda d: F.size(d["found"]) > 0), lambda d: F.struct(
            d["label"].alias("label"), d["priority"].alias("priority"), d["number"].alias("number"), d["base"].alias("base"),
            d["confidence"].alias("confidence"), d["start"].alias("start"),
            (d["start"] + F.size(F.split(F.get(d["found"], F.lit(0)), " "))).alias("end")))

    return seen.select("row", "key", "n_words", F.explode_outer(F.flatten(F.transform("windows", matches))).alias("d"))


def _suppressed() -> Column:
    """Whether an earlier detection in order of (start, longest, priority, rule) contains this one and outranks it."""
    own = Window.partitionBy("row").orderBy(
        F.col("d.start"), F.desc("d.end"), F.desc("d.priority"), F.col("d.number")).rowsBetween(Window.unboundedPreceding, -1)
    end_of = lambda p: F.max(F.when(~F.col("d.base") & (F.col("d.priority") >= p), F.col("d.end"))).over(own)
    covered = F.lit(False)
    for p in _PRIORITIES:
        covered = F.when(F.col("d.priority") == p, F.coalesce(end_of(p) >= F.col("d.end"), F.lit(False))).otherwise(covered)
    return covered


def scan(docs: DataFrame, rules: list[license_rules.Rule] | None = None, key: str = "doc_id",
         text: str = "text") -> DataFrame:
    """One row per detection that is not suppressed, and base phrase, plus rows of nulls; columns as ``detections``."""
    return detections(docs, rules, key, text).withColumn("suppressed", _suppressed()).where(
        "d is null or d.base or not suppressed").drop("suppressed")


def report(docs: DataFrame, rules: list[license_rules.Rule] | None = None, key: str = "doc_id",
           text: str = "text") -> DataFrame:
    """One row per input row: (key, n_words, n_base, first_word, last_word, base_labels, labels, score)."""
    base = F.col("d.base")
    joined = lambda c: F.concat_ws(",", F.array_sort(F.collect_set(c)))
    return (scan(docs, rules, key, text).groupBy("row").agg(
                F.first("key").alias(key), F.first("n_words").alias("n_words"),
                F.count(F.when(base, 1)).alias("n_base"),
                F.min(F.when(base, F.col("d.start"))).alias("first_word"), F.max(F.when(base, F.col("d.start"))).alias("last_word"),
                joined(F.when(base, F.col("d.label"))).alias("base_labels"), joined(F.col("d.label")).alias("labels"),
                F.coalesce(F.max("d.confidence"), F.lit(0.0)).alias("score")).drop("row"))
