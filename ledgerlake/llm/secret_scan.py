"""Operator 8: secret scanning over a trigram index (DataFrame functions only).

Each rule is a regular expression. ``trigram_query`` derives from it which trigrams a
matching text must hold, as alternatives of trigram sets; the trigrams of all rules
make the index vocabulary. The inverted index lists, per trigram of that vocabulary,
the documents that hold it (ASCII letters folded). Postings are intersected per
alternative by counting: a document is a candidate of a rule if it is in all lists of
one alternative. Only candidates are searched with the rule's expression; rules
without a mandatory trigram (long hexadecimal strings) are searched in every text.

Spans are [start, end) in code points, leftmost and non-overlapping per kind. They are
found by marking the matches with a control character and adding up the lengths
between the marks. Defined results: null and empty texts have no spans. A text that
holds the marking character is searched with a like character in its place. Rows that
share a doc_id and a text share their candidates; other columns pass on.
"""

from __future__ import annotations

from dataclasses import dataclass
from re import _constants as sre
from re import _parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlake.llm.scratch import small, stored

MARK, LIKE = "\x01", "\x02"


@dataclass(frozen=True)
class Rule:
    """kind; pattern; least length of the match, or of one of its groups."""
    kind: str
    pattern: str
    least: int = 0
    group: int = 0


# Kinds in listing order and their patterns.
BASE = (
    Rule("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 6, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 20),
    Rule("hex", r"[0-9a-f]{24,}"),
)
FURTHER = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("stripe", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{10,}\.eyJ[A-Za-z0-9_-]{10,}\.[A-Za-z0-9_-]{10,}"),
)
# End of the fixed values.
RULES = BASE + FURTHER


def _trigrams(s: str) -> frozenset[str]:
    return frozenset(s[i:i + 3] for i in range(len(s) - 2))


def trigram_query(pattern: str, most: int = 16) -> list[frozenset[str]]:
    """Alternatives of trigram sets (letters folded) of which every match holds one
    whole; an empty list if no trigram is mandatory. Literal runs, small classes,
    alternatives and optional literals are followed; anything else ends a run."""
    clauses: list[list[frozenset[str]]] = []

    def close(runs: set[str]) -> set[str]:
        if runs and all(len(r) >= 3 for r in runs):
            clauses.append([_trigrams(r) for r in sorted(runs)])
        return {""}

    def options(op, arg) -> set[str] | None:
        """All strings of one element, or None if they are too many."""
        if op is sre.LITERAL:
            return {chr(arg).lower()}
        if op is sre.IN and all(o is sre.LITERAL for o, _ in arg) and len(arg) <= 5:
            return {chr(a).lower() for _, a in arg}
        if op is sre.SUBPATTERN:
            return whole(arg[3])
        if op is sre.BRANCH:
            parts = [whole(b) for b in arg[1]]
            return None if None in parts else set().union(*parts)
        if op is sre.MAX_REPEAT and arg[0] == 0 and arg[1] == 1 and arg[2][0][0] is sre.LITERAL:
            inner = whole(arg[2])
            return None if inner is None else inner | {""}
        if op is sre.MAX_REPEAT and arg[0] == arg[1] and arg[0] <= 3:
            return whole([*arg[2]] * arg[0])
        return None

    def whole(items) -> set[str] | None:
        runs = {""}
        for op, arg in items:
            got = options(op, arg)
            if got is None or len(runs) * len(got) > most:
                return None
            runs = {r + g for r in runs for g in got}
        return runs

    runs = {""}
    for op, arg in _parser.parse(pattern):
        got = options(op, arg)
        if got is None or len(runs) * len(got) > most:
            runs = close(runs)
            if got is not None:
                runs = set(got)
        else:
            runs = {r + g for r in runs for g in got}
    close(runs)
    query = [frozenset()] if clauses else []
    for clause in clauses:
        query = [a | b for a in query for b in clause]
    return list(dict.fromkeys(query))


def trigram_index(docs: DataFrame, vocabulary: list[str]) -> DataFrame:
    """(trigram, doc_id, tag): the postings of the vocabulary's trigrams."""
    folded = docs.select("doc_id", "tag", F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("folded"))
    # one flag column per trigram: as one expression, the explode would have it evaluated twice
    flags = folded.select("doc_id", "tag", *[F.contains("folded", F.lit(t)).alias(f"t{i}") for i, t in enumerate(vocabulary)])
    held = F.filter(F.array(*[F.when(F.col(f"t{i}"), F.lit(t)) for i, t in enumerate(vocabulary)]), lambda t: t.isNotNull())
    return flags.select("doc_id", "tag", F.explode(held).alias("trigram"))


def candidates(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """(doc_id, tag, rules): the documents whose trigrams satisfy the query of a rule."""
    queries = [(r.kind, i, sorted(a)) for r in rules for i, a in enumerate(trigram_query(r.pattern))]
    vocabulary = sorted({t for _, _, a in queries for t in a})
    wanted = docs.sparkSession.createDataFrame(
        [(k, i, 1 << j, (1 << len(a)) - 1, t) for k, i, a in queries for j, t in enumerate(a)],
        "rule string, alternative int, bit long, whole long, trigram string")
    met = trigram_index(docs, vocabulary).join(F.broadcast(wanted), "trigram")  # as many rows as the rules' trigrams
    held = met.groupBy("doc_id", "tag", "rule", "alternative", "whole").agg(F.bit_or("bit").alias("bits"))
    return held.filter("bits = whole").groupBy("doc_id", "tag").agg(F.collect_set("rule").alias("rules"))


def rule_spans(text: Column, rule: Rule, order: int) -> Column:
    """Spans (start, order, end, kind) of one rule in a text."""
    clean = F.when(F.contains(text, F.lit(MARK)), F.translate(text, MARK, LIKE)).otherwise(text)
    parts = F.split(F.regexp_replace(clean, f"(?:{rule.pattern})", f"{MARK}$0{MARK}"), MARK, -1)
    empty = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")

    def add(state: Column, part: Column) -> Column:
        start = state["at"]
        end = start + F.length(part)
        size = F.length(F.regexp_extract(part, rule.pattern, rule.group)) if rule.group else F.length(part)
        span = F.array(F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"),
                                F.lit(rule.kind).alias("kind")))
        taken = state["match"] & (size >= rule.least)
        return F.struct(end.alias("at"), (~state["match"]).alias("match"),
                        F.when(taken, F.concat(state["out"], span)).otherwise(state["out"]).alias("out"))

    found = F.aggregate(parts, F.struct(F.lit(0).alias("at"), F.lit(False).alias("match"), empty.alias("out")), add,
                        lambda s: s["out"])
    return F.when(F.rlike(text, F.lit(rule.pattern)), found).otherwise(empty)


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs`` with spans (start, end, kind), by start, then kind as listed."""
    tagged = docs.drop("_id", "_found_tag", "_rules").withColumn("_tag", F.xxhash64("text"))
    found = small(stored(candidates(tagged.select("doc_id", F.col("_tag").alias("tag"), "text"), rules), "candidates"))
    found = found.withColumnsRenamed({"doc_id": "_id", "tag": "_found_tag", "rules": "_rules"})
    both = tagged.join(found, F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_tag") == F.col("_found_tag")), "left")
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")
    lists = [rule_spans(text, r, i) if not trigram_query(r.pattern) else
             F.when(F.array_contains(F.col("_rules"), r.kind), rule_spans(text, r, i)).otherwise(none)
             for i, r in enumerate(rules)]
    spans = F.transform(F.array_sort(F.concat(*lists)),
                        lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"), s["kind"].alias("kind")))
    return both.withColumn("spans", spans).drop("_tag", "_id", "_found_tag", "_rules")


def redact(rows: DataFrame) -> DataFrame:
    """``rows`` with every span of text replaced by its kind in angle brackets; spans is dropped."""
    kept = F.aggregate(
        "spans", F.struct(F.lit(0).alias("at"), F.lit("").alias("out")),
        lambda s, x: F.when(x["start"] >= s["at"], F.struct(
            x["end"].alias("at"), F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, x["start"] - s["at"]),
                                           F.lit("<"), F.upper(x["kind"]), F.lit(">")).alias("out")))
        .otherwise(F.struct(F.greatest(s["at"], x["end"]).alias("at"), s["out"].alias("out"))),
        lambda s: F.concat(s["out"], F.substring(F.col("text"), s["at"] + 1, F.length("text"))))
    return rows.withColumn("text", F.when(F.size("spans") > 0, kept).otherwise(F.col("text"))).drop("spans")
