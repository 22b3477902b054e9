"""License scans: gated signature rules, overlaps resolved by priority and containment. DataFrame functions only."""

from __future__ import annotations

import json
import re
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.llm.license_rules import RULES, SPAN, Rule

# Words are runs of ASCII letters, digits and anything beyond ASCII (fixed by the contract, which
# lower-cases first; here letters of both cases are kept).
BREAK = "[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_RULE = "struct<rule:int,label:string,need:string,pattern:string,priority:int,confidence:double,base:boolean>"
_FOUND = "start:bigint,end:bigint,label:string,rule:int,priority:int,confidence:double,base:boolean"
FOUND = f"array<struct<{_FOUND},kept:boolean>>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often it is used."""
    return F.element_at(F.transform(F.array(value), body), 1)


def _spaces(text: Column) -> Column:
    return F.length(text) - F.length(F.replace(text, F.lit(" ")))


def needed_word(rule: Rule) -> str:
    """The longest word besides the gate that every match of a rule holds; empty if there is none."""
    plain = rule.pattern
    while (shorter := re.sub(r"\([^()]*\)\??", " ", plain)) != plain:  # options and alternatives
        plain = shorter
    words = [w for w in plain.split() if re.fullmatch("[a-z0-9]+", w)]
    return max(words, key=len, default="")


def _rules_by_gate(rules: Sequence[Rule]) -> Column:
    table: dict[str, list[dict]] = {}
    for r in rules:
        # A match begins and ends at whole words.
        one = {"rule": r.rule, "label": r.label, "need": needed_word(r), "pattern": f" {r.pattern} ", "priority": r.priority,
               "confidence": r.confidence, "base": r.base}
        table.setdefault(r.gate, []).append(one)
    return F.from_json(F.lit(json.dumps(table)), f"map<string,array<{_RULE}>>")


def _matches(words: Column, rules: Sequence[Rule]) -> Column:
    """All matches: for each word that gates a rule, its neighbourhood is tried with those of that
    word's rules whose other needed word stands there too. A match holds its gate at the mark, so each place gives one match a rule at most."""
    by_gate = _rules_by_gate(rules)

    def around(place: Column) -> Column:
        at = place["at"]
        before = F.slice(words, F.greatest(at + 1 - SPAN, F.lit(1)), F.least(at, F.lit(SPAN)))
        after = F.slice(words, at + 1, SPAN)
        return F.concat(F.lit(" "), F.array_join(before, " "), F.when(at > 0, " ").otherwise(""), F.lit("<"),
                        F.array_join(after, " "), F.lit(" "))

    def tried(place: Column) -> Column:
        def match(rule: Column, text: Column) -> Column:
            def located(found: Column) -> Column:
                start = place["at"] - _spaces(F.substring_index(found, "<", 1)) + 1
                return F.when(found.isNotNull(), F.struct(
                    start.cast("long").alias("start"), (start + _spaces(found) - 1).cast("long").alias("end"),
                    rule["label"].alias("label"), rule["rule"].alias("rule"), rule["priority"].alias("priority"),
                    rule["confidence"].alias("confidence"), rule["base"].alias("base")))

            return _let(F.regexp_substr(text, rule["pattern"]), located)

        return _let(around(place), lambda text: F.filter(
            F.transform(F.filter(F.element_at(by_gate, place["gate"]), lambda rule: F.contains(text, rule["need"])),
                        lambda rule: match(rule, text)), lambda m: m.isNotNull()))

    gates = sorted({r.gate for r in rules})
    places = F.filter(F.transform(words, lambda w, i: F.struct(i.alias("at"), w.alias("gate"))),
                      lambda p: p["gate"].isin(gates))
    return F.flatten(F.transform(places, tried))


def _resolved(found: Column) -> Column:
    """Each match with ``kept``. One that lies within another of smaller priority (or the same
    and longer, or at last of a smaller rule number) is suppressed.

    In the order by start and falling end all that contain a match stand before it. They start
    within ``SPAN`` words, and one match of each interval is enough, so that looking back
    ``SPAN * SPAN`` places sees them all; work grows with the number of matches.
    """
    def order(m: Column) -> Column:
        return F.struct(m["start"].alias("s"), (-m["end"]).alias("e"), m["priority"].alias("p"), m["rule"].alias("r"),
                        m.alias("m"))

    def better(g: Column, h: Column) -> Column:
        """``g`` wins over ``h``, which it contains."""
        length = lambda m: m["end"] - m["start"]
        return (g["priority"] < h["priority"]) | ((g["priority"] == h["priority"]) & (
            (length(g) > length(h)) | ((length(g) == length(h)) & (g["rule"] < h["rule"]))))

    def told(m: Column, kept: Column) -> Column:
        names = [c.split(":")[0] for c in _FOUND.split(",")]
        return F.struct(*[m[c].alias(c) for c in names], kept.alias("kept"))

    def marked(ordered: Column) -> Column:
        """The first of each interval is judged; the others have the same place and a lower rank."""
        same = lambda a, b: (a["start"] == b["start"]) & (a["end"] == b["end"])
        numbered = F.transform(ordered, lambda x, i: F.struct(x["m"].alias("m"), (
            (i == 0) | ~same(F.get(ordered, F.greatest(i - 1, F.lit(0)))["m"], x["m"])).alias("first")))

        def judged(best: Column) -> Column:
            return F.transform(best, lambda x, i: told(x["m"], ~F.exists(
                F.slice(best, F.greatest(i + 1 - SPAN * SPAN, F.lit(1)), F.least(i, F.lit(SPAN * SPAN))),
                lambda g: (g["m"]["end"] >= x["m"]["end"]) & better(g["m"], x["m"]))))

        return _let(numbered, lambda all_: F.array_sort(F.concat(
            _let(F.filter(all_, lambda x: x["first"]), judged),
            F.transform(F.filter(all_, lambda x: ~x["first"]), lambda x: told(x["m"], F.lit(False))))))

    return _let(F.array_sort(F.transform(found, order)), marked)


def scan_licenses(docs: DataFrame, rules: Sequence[Rule] = tuple(RULES)) -> DataFrame:
    """License signatures in whole texts: doc_id, n_words, detections.

    ``detections`` lists all matches by place: start and end (words from 0, end exclusive),
    label, rule, priority, confidence, base (a phrase of the contract) and kept (not suppressed
    by a match of higher rank that contains it).

    A text without any gate word is not cut into words. Rules are a literal table, so nothing
    is shuffled or broadcast, and a row's work grows with its own text.

    A null or empty text has no words and no detections. Rows are independent: repeated rows
    and null ids give a row each; other columns play no part. An empty table gives an empty
    result. Equal ranks cannot occur, as rules are numbered.
    """
    gates = "|".join(sorted({r.gate for r in rules}))
    gated = f" (?:{gates}) "
    empty = F.from_json(F.lit("[]"), FOUND)

    def scan(spaced: Column) -> Column:
        def detect(words: Column) -> Column:
            return _resolved(_matches(words, rules))

        folded = F.translate(spaced, _UPPER, _LOWER)
        words = F.split(F.trim(folded), " ")
        return F.struct(
            F.greatest(_spaces(spaced) - 1, F.lit(0)).cast("long").alias("n_words"),
            F.when(spaced.rlike(f"(?i){gated}"), _let(words, detect)).otherwise(empty).alias("detections"))

    # One space before, between and after the words.
    text = F.concat(F.lit(" "), F.coalesce("text", F.lit("")), F.lit(" "))
    return docs.select("doc_id", _let(F.regexp_replace(text, BREAK, " "), scan).alias("found")).select("doc_id", "found.*")


def license_report(docs: DataFrame, rules: Sequence[Rule] = tuple(RULES)) -> DataFrame:
    """One row per document: number and places of base phrases, labels, and the highest
    confidence of a kept detection (0 without any)."""
    found = scan_licenses(docs, rules)
    every = F.col("detections")
    kept = F.filter(every, lambda d: d["kept"])

    def joined(which: Column) -> Column:
        return F.array_join(F.array_sort(F.array_distinct(F.transform(which, lambda d: d["label"]))), ",")

    base = F.filter(every, lambda d: d["base"])
    starts = F.transform(base, lambda d: d["start"])
    return found.select(
        "doc_id", "n_words", F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"), F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"), joined(F.filter(every, lambda d: d["base"] | d["kept"])).alias("labels"),
        F.coalesce(F.array_max(F.transform(kept, lambda d: d["confidence"])), F.lit(0.0)).alias("score"))
