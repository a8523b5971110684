"""Row checks on text, duplicate keys, group integrity and the valid / quarantined split."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierline.functions.names import FILE_PATH, ROW_INDEX, col, data_columns
from tierline.functions.spread import HOT_ROWS, attach_by_key, is_small, materialize, top_per_key
from tierline.functions.text import as_date, as_decimal, as_number, described_key

REASONS = "_dq_reasons"
FAILED = "_dq_failed"
_INTEGRITY_MODES = ("strict", "row_level", "group_level")


@dataclass(frozen=True)
class Rule:
    """What a column must satisfy as text and which type it gets afterwards.

    ``checks`` holds names (``not_null``, ``non_empty``, ``valid_date``,
    ``is_numeric`` or a registered one) and one-entry comparisons such as
    ``{"greater_than": 0}``. ``lookup`` names a reference given to
    :func:`check_rows`.
    """

    column: str
    checks: tuple[str | Mapping[str, float], ...] = ()
    cast_to: str | None = None
    precision: int | None = None
    scale: int | None = None
    format: str | None = None
    lookup: str | None = None

    def __post_init__(self) -> None:
        if self.cast_to not in (None, "date", "decimal"):
            raise ValueError(f"{self.column}: cast_to must be date or decimal, not {self.cast_to!r}")
        if (self.cast_to == "date" or "valid_date" in self.checks) and not self.format:
            raise ValueError(f"{self.column}: dates need a format")


@dataclass(frozen=True)
class Cell:
    """A text value and what it parses to; each is computed once per row."""

    value: Column
    number: Column
    date: Column | None


def _cell(rule: Rule) -> Cell:
    value = col(rule.column)
    return Cell(value, as_number(value), as_date(value, rule.format) if rule.format else None)


# Each check says when a value FAILS. NULL passes everything but not_null, which
# the caller takes care of.
Check = Callable[[Cell, Rule], Column]

CHECKS: dict[str, Check] = {
    "non_empty": lambda cell, rule: F.length(cell.value) == 0,
    "valid_date": lambda cell, rule: cell.date.isNull(),
    "is_numeric": lambda cell, rule: cell.number.isNull(),
}
COMPARISONS: dict[str, Callable[[Column, float], Column]] = {
    "greater_than_or_equal": lambda n, limit: n >= limit,
    "greater_than": lambda n, limit: n > limit,
    "less_than_or_equal": lambda n, limit: n <= limit,
    "less_than": lambda n, limit: n < limit,
}


def register_check(name: str, fails: Callable[[Column, Rule], Column]) -> None:
    """Adds a check ``(value, rule) -> failing`` made of Spark expressions."""
    CHECKS[name] = lambda cell, rule: fails(cell.value, rule)


@dataclass(frozen=True)
class Condition:
    column: str
    label: str
    fails: Column

    @property
    def reason(self) -> str:
        return f"{self.column}: {self.label}"


def conditions(rules: list[Rule], cells: list[Cell] | None = None) -> list[Condition]:
    """One failing condition per check, in rule order."""
    out = []
    for rule, cell in zip(rules, cells or [_cell(r) for r in rules]):
        value = cell.value
        for check in rule.checks:
            if isinstance(check, str):
                if check == "not_null":
                    out.append(Condition(rule.column, "not_nullable", value.isNull()))
                elif check in CHECKS:
                    fails = F.coalesce(CHECKS[check](cell, rule), F.lit(False))
                    out.append(Condition(rule.column, check, value.isNotNull() & fails))
                else:
                    raise ValueError(f"unknown check {check!r} on column {rule.column!r}")
                continue
            if len(check) != 1:
                raise ValueError(f"{rule.column}: a comparison has exactly one threshold")
            (op, limit), = check.items()
            if op not in COMPARISONS:
                raise ValueError(f"unsupported comparison {op!r} on column {rule.column!r}")
            holds = F.coalesce(COMPARISONS[op](cell.number, F.lit(float(limit))), F.lit(False))
            out.append(Condition(rule.column, op, value.isNotNull() & ~holds))
    return out


def _decimal(rule: Rule) -> str:
    return f"decimal({rule.precision or 38},{rule.scale or 0})"


def cast_value(rule: Rule) -> Column | None:
    """The typed value of a rule's column, NULL where the text does not fit the type."""
    if rule.cast_to == "date":
        return as_date(col(rule.column), rule.format)
    if rule.cast_to == "decimal":
        return as_decimal(col(rule.column), rule.precision, rule.scale)
    return None


def apply_casts(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Types the columns that have a ``cast_to`` and are present; the rest stays text."""
    casts = {r.column: cast_value(r) for r in rules if r.cast_to and r.column in df.columns}
    return df.select(*[casts[c].alias(c) if c in casts else col(c) for c in df.columns])


_FLAGS_PER_COLUMN = 60


def _flags(fails: list[Column]) -> list[Column]:
    """The conditions as bits of as few numbers as possible."""
    out = []
    for start in range(0, len(fails), _FLAGS_PER_COLUMN):
        bits = [F.when(f, F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, f in enumerate(fails[start : start + _FLAGS_PER_COLUMN])]
        out.append(reduce(lambda a, b: a + b, bits))
    return out


def _flagged(names: list[str], n: int) -> list[Column]:
    return [
        F.col(names[i // _FLAGS_PER_COLUMN]).bitwiseAND(F.lit(1 << (i % _FLAGS_PER_COLUMN)).cast("long")) != 0 for i in range(n)
    ]


def with_own_reasons(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """Adds the reasons a row carries by itself: its checks, or a cast its text does not fit.

    Three projections: parse every cell once, test every condition once into bits,
    and build lists for the rows that have a bit set.
    """
    unknown = sorted({r.column for r in rules if r.checks} - set(df.columns))
    if unknown:
        raise ValueError(f"rules name columns that are not in the data: {unknown}")
    known = [r for r in rules if r.column in df.columns]
    parsed: dict[str, Column] = {}
    cells = []
    for i, rule in enumerate(known):
        raw = _cell(rule)
        parsed[f"__num{i}"] = raw.number
        if raw.date is not None:
            parsed[f"__date{i}"] = raw.date
        cells.append(Cell(raw.value, F.col(f"__num{i}"), F.col(f"__date{i}") if raw.date is not None else None))

    checks = conditions(known, cells)
    misfits = []
    for rule, cell in zip(known, cells):
        if rule.cast_to == "date":
            misfits.append((f"{rule.column}: cast_failed", cell.value.isNotNull() & cell.date.isNull()))
        elif rule.cast_to == "decimal":
            # A number that is none already failed its check where there is one.
            fits = cell.number.isNotNull() & cell.value.try_cast(_decimal(rule)).isNotNull()
            misfits.append((f"{rule.column}: cast_failed", cell.value.isNotNull() & ~fits))

    flags = {f"__flags{i}": c for i, c in enumerate(_flags([c.fails for c in checks]))}
    misfit_flags = {f"__misfit{i}": c for i, c in enumerate(_flags([f for _, f in misfits]))}
    tested = df.withColumns(parsed).withColumns({**flags, **misfit_flags})

    result, failed = F.array().cast("array<string>"), F.lit(False)
    for names, reasons in ((list(misfit_flags), [r for r, _ in misfits]), (list(flags), [c.reason for c in checks])):
        if names:
            hit = reduce(lambda a, b: a | b, (F.col(n) != 0 for n in names))
            listed = F.array_compact(
                F.array(*[F.when(f, F.lit(r)) for f, r in zip(_flagged(names, len(reasons)), reasons)])
            )
            result, failed = F.when(hit, listed).otherwise(result), hit | failed
    # The flag does not go through the list: a filter on it stays cheap when it is pushed down.
    return tested.select(*[col(c) for c in df.columns], result.alias(REASONS), failed.alias(FAILED))


def _add_reason(df: DataFrame, when: Column, reason: Column) -> DataFrame:
    """Appends a reason to the rows where ``when`` holds."""
    kept = [col(c) for c in df.columns if c not in (REASONS, FAILED)]
    listed = F.when(when, F.concat(REASONS, F.array(reason))).otherwise(F.col(REASONS))
    return df.select(*kept, listed.alias(REASONS), (F.col(FAILED) | when).alias(FAILED))


def duplicate_keys(df: DataFrame, key: list[str], *, scope: list[str], order: str) -> DataFrame:
    """Keys that occur more than once per scope, their first position and row count."""
    return (
        df.groupBy(*[col(c) for c in scope + key])
        .agg(F.min(order).alias("_dq_first"), F.count(F.lit(1)).alias("_dq_rows"))
        .filter(F.col("_dq_rows") > 1)
    )


def _flag_missing_reference(df: DataFrame, column: str, reference: DataFrame, key: str, hot_rows: int) -> tuple[DataFrame, bool]:
    """Adds ``_dq_miss``; the second result says whether rows were joined through a shuffle."""
    known = reference.select(col(key).cast("string").alias("__ref")).filter(F.col("__ref").isNotNull()).distinct()
    if is_small(reference):
        hit = F.broadcast(known.withColumn("__hit", F.lit(True)))
        joined = df.join(hit, col(column) == F.col("__ref"), "left")
        flag = col(column).isNotNull() & F.col("__hit").isNull()
        return joined.withColumn("_dq_miss", flag).drop("__ref", "__hit"), False
    # A large reference: test the distinct values, then bring the misses to the rows.
    seen = df.groupBy(col(column).alias("__value")).agg(F.count(F.lit(1)).alias("_dq_rows"))
    misses = (
        seen.filter(F.col("__value").isNotNull())
        .join(known, F.col("__value") == F.col("__ref"), "left_anti")
        .select(F.col("__value").alias(column), "_dq_rows", F.lit(True).alias("_dq_miss"))
    )
    return attach_by_key(df, misses, [column], ["_dq_miss"], rows="_dq_rows", hot_rows=hot_rows), True


def check_rows(
    df: DataFrame,
    rules: list[Rule],
    *,
    lookups: Mapping[str, tuple[DataFrame, str]] | None = None,
    business_key: list[str] | None = None,
    group_by: list[str] | None = None,
    file_columns: list[str] | None = None,
    row_index: str = ROW_INDEX,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Adds ``_dq_reasons`` (checks, lookups, duplicate key, group) and ``_dq_failed``.

    ``lookups`` maps the lookup names of the rules to ``(reference, key column)``.
    Duplicates and groups are judged per file (``file_columns``). ``df`` should be a
    landed table; where several row joins are needed the intermediate result is
    written to the shared folder once.
    """
    scope = [FILE_PATH] if file_columns is None else file_columns
    columns = df.columns
    out = with_own_reasons(df, rules)
    joined = False

    for rule in rules:
        if rule.lookup is None:
            continue
        if not lookups or rule.lookup not in lookups:
            raise ValueError(f"{rule.column}: no reference given for lookup {rule.lookup!r}")
        reference, key = lookups[rule.lookup]
        if joined:
            out, joined = materialize(out, "checked"), False
        out, joined = _flag_missing_reference(out, rule.column, reference, key, hot_rows)
        out = _add_reason(out, F.coalesce("_dq_miss", F.lit(False)), F.lit(f"{rule.column}: sql_lookup")).drop("_dq_miss")

    if business_key and all(c in columns for c in business_key):
        if joined:
            out, joined = materialize(out, "checked"), False
        repeated = duplicate_keys(out, business_key, scope=scope, order=row_index)
        out = attach_by_key(out, repeated, scope + business_key, ["_dq_first"], rows="_dq_rows", hot_rows=hot_rows)
        joined = True
        shown = F.concat(F.lit("duplicate business key: "), described_key([(c, col(c)) for c in business_key]))
        later = F.coalesce(col(row_index) > F.col("_dq_first"), F.lit(False))
        out = _add_reason(out, later, shown).drop("_dq_first")

    if group_by and all(c in columns for c in group_by):
        if joined:
            out, joined = materialize(out, "checked"), False
        bad_groups = (
            out.groupBy(*[col(c) for c in scope + group_by])
            .agg(F.bool_or(FAILED).alias("_dq_group"), F.count(F.lit(1)).alias("_dq_rows"))
            .filter("_dq_group")
        )
        out = attach_by_key(out, bad_groups, scope + group_by, ["_dq_group"], rows="_dq_rows", hot_rows=hot_rows)
        shown = F.concat(
            F.lit("quarantined with group "), described_key([(c, col(c)) for c in group_by]),
            F.lit(" - another row in this group failed DQ"),
        )
        swept = F.coalesce("_dq_group", F.lit(False)) & ~F.col(FAILED)
        out = _add_reason(out, swept, shown).drop("_dq_group")

    return out.select(*[col(c) for c in columns], REASONS, FAILED)


def blocked_files(checked: DataFrame, *, file_columns: list[str] | None = None) -> DataFrame:
    """Files with at least one failing row, with their row counts."""
    scope = [FILE_PATH] if file_columns is None else file_columns
    return (
        checked.groupBy(*[col(c) for c in scope])
        .agg(F.count(F.lit(1)).alias("_dq_rows"), F.count_if(F.col(FAILED)).alias("_dq_bad"))
        .filter(F.col("_dq_bad") > 0)
        .withColumn("_dq_blocked", F.lit(True))
    )


def split_batch(
    checked: DataFrame,
    rules: list[Rule],
    integrity_mode: str,
    *,
    file_columns: list[str] | None = None,
    hot_rows: int = HOT_ROWS,
) -> tuple[DataFrame, DataFrame]:
    """(typed valid rows, quarantined rows as text).

    ``strict`` promotes nothing from a file with a failing row; only the failing
    rows are quarantined. The other modes promote every row without a reason
    (``group_level`` sweeps groups in :func:`check_rows`).
    """
    if integrity_mode not in _INTEGRITY_MODES:
        raise ValueError(f"unsupported integrity mode {integrity_mode!r}")
    bad = checked.filter(FAILED)
    good = checked.filter(~F.col(FAILED))
    if integrity_mode == "strict":
        scope = [FILE_PATH] if file_columns is None else file_columns
        blocked = blocked_files(checked, file_columns=scope)
        good = attach_by_key(good, blocked, scope, ["_dq_blocked"], rows="_dq_rows", hot_rows=hot_rows)
        good = good.filter(F.col("_dq_blocked").isNull()).drop("_dq_blocked")
    return apply_casts(good.drop(REASONS, FAILED), rules), bad.drop(FAILED)


def validation_summary(df: DataFrame, rules: list[Rule], *, by: list[str] | None = None) -> DataFrame:
    """Per check: rows evaluated, NULLs and unexpected values, in one aggregation."""
    checks = conditions(rules)
    keys = by or []
    parts = [F.count(F.lit(1)).alias("element_count")]
    for i, c in enumerate(checks):
        parts.append(F.count_if(c.fails).alias(f"__bad_{i}"))
        parts.append(F.count_if(col(c.column).isNull()).alias(f"__null_{i}"))
    totals = df.groupBy(*[col(k) for k in keys]).agg(*parts)
    entries = F.array(
        *[
            F.struct(
                F.lit(i).alias("check_no"), F.lit(c.column).alias("column_name"), F.lit(c.label).alias("check_name"),
                F.col(f"__null_{i}").alias("missing_count"), F.col(f"__bad_{i}").alias("unexpected_count"),
            )
            for i, c in enumerate(checks)
        ]
    )
    return totals.select(*[col(k) for k in keys], "element_count", F.explode(entries).alias("__e")).select(
        *[col(k) for k in keys], "__e.check_no", "__e.column_name", "__e.check_name", "element_count",
        "__e.missing_count", "__e.unexpected_count",
        F.coalesce(F.try_divide(F.col("__e.unexpected_count") * 100.0, F.col("element_count")), F.lit(0.0)).alias(
            "unexpected_percent"
        ),
        (F.col("__e.unexpected_count") == 0).alias("success"),
    )


def unexpected_sample(df: DataFrame, rules: list[Rule], *, n: int = 20) -> DataFrame:
    """Up to ``n`` distinct failing values per check, smallest first, as a list."""
    checks = conditions(rules)
    failing = F.array_compact(
        F.array(*[
            F.when(c.fails, F.struct(F.lit(i).alias("check_no"), F.lit(c.column).alias("column_name"),
                                     F.lit(c.label).alias("check_name"), col(c.column).alias("value")))
            for i, c in enumerate(checks)
        ])
    )
    values = df.select(F.explode(failing).alias("e")).select("e.*").distinct()
    keys = ["check_no", "column_name", "check_name"]
    shown = top_per_key(values, keys, [F.asc_nulls_first("value")], n, rank="place")
    # At most n values per check are left here.
    return shown.groupBy(*keys).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("place", "value"))), lambda e: e["value"]).alias("sample_values")
    )


def distinct_reasons(quarantined: DataFrame, by: list[str]) -> DataFrame:
    """Every reason that occurs, once per group."""
    return quarantined.select(*[col(b) for b in by], F.explode(REASONS).alias("reason")).distinct()


def original_row(df: DataFrame) -> Column:
    """The data columns of a row as a map from name to text."""
    names = data_columns(df.columns)
    return F.create_map(*[x for c in names for x in (F.lit(c), col(c).cast("string"))])
