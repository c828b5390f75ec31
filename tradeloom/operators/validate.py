"""Validation: normalise, test all rules in one projection, split, count, gate.

A tagged frame carries one integer, ``_hits``, whose bit *i* says that rule
*i* was violated.  Counts, rejects and valid rows are all read off that bit
set, so each rule condition is evaluated once per record.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping
from concurrent.futures import Future, ThreadPoolExecutor
from decimal import Decimal
from functools import reduce

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import IntegralType

from tradeloom.contracts import OVERALL_RULE, QUALITY_THRESHOLD, SOURCE_SCHEMAS, SOURCE_TABLES
from tradeloom.functions.parse import parse_date, parse_decimal
from tradeloom.functions.text import norm_code, norm_text
from tradeloom.operators import joins
from tradeloom.operators.joins import exceptions_join, input_bytes, lookup_join
from tradeloom.operators.rules import DUPLICATE, SPECS, TableSpec, known
from tradeloom.sources.sample import LazyFrames

HITS = "_hits"
MALFORMED_RULE = "malformed_record"
#: How the rules are named that compare a record with others.
MET_RULES = ("duplicate_", "orphan_")
#: How many times a table's input must be its parent's for its distinct parent ids to count as few.
MANY_PER_PARENT = 5
#: Decimal places that numbers keep until amounts are rounded: with them a price times a quantity, and a discount on an
#: amount, fit 38 digits exactly.
WORKING_PLACES = 16


def normalise(spec: TableSpec, raw: DataFrame) -> DataFrame:
    """Clean text and codes, parse numbers (exact decimals) and dates."""
    cleaned: dict[str, Column] = {}
    for name in spec.columns:
        c = F.col(name)
        if name in spec.codes:
            cleaned[name] = norm_code(c)
        elif name in spec.text:
            cleaned[name] = norm_text(c)
        elif name in spec.dates:
            cleaned[name] = parse_date(c)
        else:
            cleaned[name] = parse_decimal(c)
    return raw.select("_raw_id", *[c.alias(n) for n, c in cleaned.items()])


def working_type(load_type: str) -> str:
    """A load type's decimal with the places that amounts are computed from."""
    precision, scale = map(int, re.findall(r"[0-9]+", load_type))
    return f"decimal({precision - scale + WORKING_PLACES},{WORKING_PLACES})"


def _working_types(spec: TableSpec) -> dict[str, Column]:
    """The parsed numbers in the types later steps compute with: the whole digits of the load type, ``WORKING_PLACES`` behind."""
    narrowed = {n: F.col(n).try_cast(working_type(SOURCE_SCHEMAS[spec.name][n])) for n in spec.numbers if n not in spec.integers}
    # Of 18 digits, a whole number is a long and becomes an integer without a detour over a double.
    narrowed.update({n: F.bround(F.col(n), 0).try_cast("decimal(18,0)").try_cast("int") for n in spec.integers})
    return narrowed


def _beyond_load_type(column: str, load_type: str) -> Column:
    """Whether a parsed number has more whole digits than its load type, once it is rounded half up to its places."""
    precision, scale = map(int, re.findall(r"[0-9]+", load_type))
    bound = F.lit(Decimal(10) ** (precision - scale) - Decimal(5).scaleb(-scale - 1))
    return (F.col(column) >= bound) | (F.col(column) <= -bound)


def typed(spec: TableSpec, raw: DataFrame) -> DataFrame:
    """Normalised rows in working types, without judging them."""
    return normalise(spec, raw).withColumns(_working_types(spec))


def mark_duplicates(df: DataFrame, spec: TableSpec) -> DataFrame:
    """Flag every row after the first of its key, whether or not the first is valid.

    The first arrival per key is a partial aggregate, so a key that holds a
    large share of the rows shrinks to one row per task before it is shuffled.
    Only keys that do repeat are joined back: one row per key.
    """
    dated = [F.col(k).isNotNull() for k in spec.key if k in spec.dates]
    usable = dated[0] if dated else F.col(spec.key[0]) != ""
    # Arrivals that are no plain number are aggregated by sorting, which compares whole ids where their first
    # eight bytes are alike; a hash in front of them tells them apart.
    by_hash = [] if isinstance(df.schema["_raw_id"].dataType, IntegralType) else [F.hash(*spec.key).alias("_hash")]
    repeated = (
        df.filter(usable)
        .groupBy(*by_hash, *spec.key)
        .agg(F.min("_raw_id").alias("_first"), F.count("*").alias("_n"))
        .filter(F.col("_n") > 1)
        .drop("_n", "_hash")
    )
    later = F.coalesce(F.col("_raw_id") > F.col("_first"), F.lit(False))
    return exceptions_join(df, repeated, list(spec.key)).withColumn(DUPLICATE, later).drop("_first")


def mark_known(df: DataFrame, column: str, parent_keys: DataFrame) -> DataFrame:
    """Left join to the valid parents' keys; the marker is NULL for an orphan.

    Where the parents are too many to broadcast but few beside the rows, the
    rows' distinct ids are checked against them, and rows meet the exceptions only.
    """
    keys = parent_keys.select(F.col(column), F.lit(True).alias(known(column)))
    if not _few_parents(df, keys):
        return lookup_join(df, keys, column, "left")
    marker = F.col(known(column))
    expected = F.col(column).isNotNull() & F.coalesce(marker, F.lit(True))
    marked = exceptions_join(df, _exceptions(df, column, parent_keys), column)
    return marked.withColumn(known(column), F.when(expected, F.lit(True)))


def _few_parents(df: DataFrame, keys: DataFrame) -> bool:
    rows, parents = input_bytes(df), input_bytes(keys)
    if rows is None or parents is None:
        return False
    return parents > joins.BROADCAST_INPUT_LIMIT and parents * MANY_PER_PARENT <= rows


def _exceptions(df: DataFrame, column: str, parent_keys: DataFrame) -> DataFrame:
    """The ids in ``df`` that have not exactly one parent: marked false without one, else true, a row per parent."""
    parents = parent_keys.groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    met = df.select(column).distinct().join(parents, column, "left").where("_n IS NULL OR _n > 1")
    marks = F.when(F.col("_n") > 1, F.array_repeat(F.lit(True), F.col("_n").cast("int")))
    return met.select(column, F.explode(F.coalesce(marks, F.array(F.lit(False)))).alias(known(column)))


def tag(spec: TableSpec, raw: DataFrame, parents: Mapping[str, DataFrame] | None = None) -> DataFrame:
    """Normalised rows in working types plus the bit set of violated rules.

    ``parents`` maps a parent table to a frame of its valid rows, and is asked
    once the repeated keys are known.
    """
    rules = spec.rules()
    bits = [F.when(rule.hit, F.lit(1 << i)).otherwise(F.lit(0)) for i, rule in enumerate(rules)]
    working = _working_types(spec)
    # A number beyond the working type, or beyond the type its table is loaded with, cannot
    # be stored, so its record is bad: it counts against the rule that says it is invalid.
    names = [r.name for r in rules]
    # What the load type holds fits the working type, and an integer is loaded as it is computed with.
    for n in (*spec.numbers, *spec.integers):
        rule = _range_rule(n, names)
        too_big = F.col(n).isNotNull() & working[n].isNull()
        if n not in spec.integers:
            too_big = _beyond_load_type(n, SOURCE_SCHEMAS[spec.name][n])
        bits[rule] = F.when(too_big, F.lit(1 << rule)).otherwise(bits[rule])
    # What a record decides by itself is judged before the joins, so that these move
    # one integer instead of all that the rules read.
    met = [i for i, n in enumerate(names) if n.startswith(MET_RULES)]
    own = [bit for i, bit in enumerate(bits) if i not in met]
    df = normalise(spec, raw).select(
        "_raw_id", *[working.get(n, F.col(n)).alias(n) for n in spec.columns], _any_bit(own).alias(HITS)
    )
    df = mark_duplicates(df, spec)
    for column, parent in spec.parents.items():
        df = mark_known(df, column, parents[parent])
    hits = _any_bit([F.col(HITS), *[bits[i] for i in met]])
    return df.withColumn(HITS, hits).select("_raw_id", *spec.columns, HITS)


def _any_bit(bits: list[Column]) -> Column:
    return reduce(lambda a, b: a.bitwiseOR(b), bits)


def _range_rule(column: str, rule_names: list[str]) -> int:
    """Position of the rule that rejects an unusable number in ``column``."""
    short = {"delivery_distance_km": "delivery_distance", "delivery_time_minutes": "delivery_time"}
    return rule_names.index(f"invalid_{short.get(column, column)}")


def has_hit(position: int) -> Column:
    return F.col(HITS).bitwiseAND(F.lit(1 << position)) != 0


def first_failure(spec: TableSpec) -> Column:
    """Struct of the first violated rule's name and reason; NULL for a valid row."""
    return F.coalesce(
        *[
            F.when(
                has_hit(i),
                F.struct(
                    F.lit(rule.name).alias("failed_rule"),
                    F.lit(rule.reason).alias("rejection_reason"),
                ),
            )
            for i, rule in enumerate(spec.rules())
        ]
    )


def record_identifier(spec: TableSpec) -> Column:
    """Business id as text; composite keys are joined with a bar."""
    if len(spec.key) == 1:
        return F.col(spec.key[0]).cast("string")
    return F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("")) for k in spec.key])


def valid_rows(tagged: DataFrame) -> DataFrame:
    return tagged.filter(F.col(HITS) == 0).drop(HITS)


def rejected_rows(spec: TableSpec, tagged: DataFrame) -> DataFrame:
    """Rejected rows with rule, reason and identifier next to the business columns."""
    failure = first_failure(spec)
    return (
        tagged.filter(F.col(HITS) != 0)
        .withColumns(
            {
                "record_identifier": record_identifier(spec),
                "failed_rule": failure["failed_rule"],
                "rejection_reason": failure["rejection_reason"],
            }
        )
        .drop(HITS)
    )


def validate_all(
    raw: Mapping[str, DataFrame],
    keep: Callable[[str, DataFrame], DataFrame] = lambda _name, df: df,
) -> dict[str, DataFrame]:
    """Tag all tables; a parent's valid keys feed its children.

    ``keep`` lets a batch run write each tagged table once and go on from the
    written copy instead of recomputing the cascade.  Tables are tagged side by
    side, so that the jobs of small ones leave no core idle; a table waits for its
    parents where it meets them.
    """
    running: dict[str, Future[DataFrame]] = {}
    tagged = LazyFrames(SOURCE_TABLES, lambda name: running[name].result())
    inherit = inheritable_thread_target(raw[SOURCE_TABLES[0]].sparkSession)
    with ThreadPoolExecutor(len(SOURCE_TABLES)) as pool:
        for name in SOURCE_TABLES:
            running[name] = pool.submit(inherit(lambda n: keep(n, _tag_with_parents(n, raw, tagged))), name)
        return {name: tagged[name] for name in SOURCE_TABLES}


def tagged_table(name: str, raw: dict[str, DataFrame]) -> DataFrame:
    """One tagged table together with the parents it depends on, all lazy."""
    tagged: dict[str, DataFrame] = {}
    for parent in SPECS[name].parents.values():
        if parent not in tagged:
            tagged[parent] = tagged_table(parent, raw)
    return _tag_with_parents(name, raw, tagged)


def _tag_with_parents(
    name: str, raw: Mapping[str, DataFrame], tagged: Mapping[str, DataFrame]
) -> DataFrame:
    spec = SPECS[name]
    parents = LazyFrames(tuple(spec.parents.values()), lambda parent: valid_rows(tagged[parent]))
    return tag(spec, raw[name], parents)


def rule_counts(spec: TableSpec, tagged: DataFrame) -> DataFrame:
    """One row per rule, zero hits included: all hits, and hits as the first rule."""
    return _counted(spec, tagged, []).drop("malformed")


def _counted(spec: TableSpec, tagged: DataFrame, more: list[Column], malformed: Column | None = None) -> DataFrame:
    """The rows of ``rule_counts`` and ``more``, structs like theirs over the table's totals, from one pass."""
    rules = spec.rules()
    first = F.col(HITS).bitwiseAND(-F.col(HITS))
    totals = tagged.agg(
        F.count("*").alias("records_checked"),
        *[F.count_if(has_hit(i)).alias(f"hits_{i}") for i in range(len(rules))],
        *[F.count_if(first == (1 << i)).alias(f"first_{i}") for i in range(len(rules))],
    )
    entries = [
        F.struct(
            F.lit(i + 1).alias("rule_no"),
            F.lit(rule.name).alias("rule_name"),
            F.lit(rule.reason).alias("reason"),
            F.col(f"hits_{i}").alias("records_failed"),
            F.col(f"first_{i}").alias("records_rejected"),
        )
        for i, rule in enumerate(rules)
    ]
    totals = totals.withColumn("malformed", F.lit(0).cast("bigint") if malformed is None else malformed)
    rejected = reduce(lambda a, b: a + b, [F.col(f"first_{i}") for i in range(len(rules))])
    return totals.withColumn("records_rejected_first", rejected).select(
        F.lit(spec.name).alias("table_name"),
        "records_checked",
        "malformed",
        F.inline(F.array(*entries, *more)),
    )


def _entry(name: str, failed: Column) -> Column:
    """A row like those of the rules, for something that is counted beside them."""
    return F.struct(
        F.lit(0).alias("rule_no"),
        F.lit(name).alias("rule_name"),
        F.lit("").alias("reason"),
        failed.alias("records_failed"),
        failed.alias("records_rejected"),
    )


def dq_rows(tagged: dict[str, DataFrame], malformed: dict[str, DataFrame] | None = None) -> DataFrame:
    """Result rows of a run: every rule that was hit, then the table's overall row.

    One pass per table yields both; the overall row counts rejected records,
    which is the sum over first-failing rules.  ``malformed`` has the lines that
    could not be read as records: checked and failed, by a rule of their own.
    """
    per_table = []
    for name, df in tagged.items():
        lines = malformed[name].agg(F.count("*")).scalar() if malformed else None
        more = [
            _entry(MALFORMED_RULE, F.col("malformed")),
            _entry(OVERALL_RULE, F.col("records_rejected_first") + F.col("malformed")),
        ]
        counts = _counted(SPECS[name], df, more, lines)
        shown = (F.col("records_failed") > 0) | (F.col("rule_name") == OVERALL_RULE)
        checked = (F.col("records_checked") + F.col("malformed")).alias("records_checked")
        per_table.append(counts.filter(shown).select("table_name", "rule_name", checked, "records_failed"))
    rows = reduce(DataFrame.unionByName, per_table)
    rate = F.col("records_failed").cast("double") / F.col("records_checked").cast("double")
    return rows.withColumn(
        "failure_rate",
        F.when(F.col("records_checked") > 0, rate).cast("decimal(7,4)"),
    )


def quality_scores(dq: DataFrame, threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """Per-table score and verdict from the overall rows (about eight rows)."""
    checked, failed = F.col("records_checked"), F.col("records_failed")
    score = F.when(
        checked > 0, (checked - failed).cast("double") / checked.cast("double") * F.lit(100.0)
    ).otherwise(F.lit(0.0))
    return dq.filter(F.col("rule_name") == OVERALL_RULE).select(
        "table_name",
        checked,
        failed.alias("records_rejected"),
        score.alias("quality_score"),
        ((checked > 0) & (score >= F.lit(threshold))).alias("passed"),
    )


def overall_score(scores: DataFrame) -> DataFrame:
    """One row: valid records over all records, and whether every table passed."""
    checked, rejected = F.sum("records_checked"), F.sum("records_rejected")
    return scores.agg(
        checked.alias("records_checked"),
        rejected.alias("records_rejected"),
        F.when(
            checked > 0, (checked - rejected).cast("double") / checked.cast("double") * F.lit(100.0)
        )
        .otherwise(F.lit(0.0))
        .alias("overall_score"),
        F.count_if(~F.col("passed")).alias("tables_failed"),
        F.bool_and("passed").alias("passed"),
    )


def gate(scores: DataFrame, threshold: float = QUALITY_THRESHOLD) -> tuple[bool, float, list[str]]:
    """Collect the scores (one row per table) and say whether the load may go on.

    Every source table must be there and pass; one without a score has none of its records valid.
    """
    found = {r["table_name"]: (r["records_checked"], r["records_rejected"], r["passed"]) for r in scores.collect()}
    judged = {name: found.get(name, (0, 0, False)) for name in SOURCE_TABLES}
    messages = [
        f"{name} passes {100 * (n - bad) / n if n else 0:.2f}% of {n} records, needs {threshold:.2f}%"
        for name, (n, bad, passed) in judged.items()
        if not passed
    ]
    checked, rejected = (sum(j[i] for j in judged.values()) for i in (0, 1))
    overall = (checked - rejected) / checked * 100.0 if checked else 0.0
    return not messages, overall, messages
