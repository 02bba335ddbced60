"""Contract checks. Violations are reported as rows; nothing is repaired or dropped here."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plantmart.contracts import LOADED_AT, PLANTS, SOURCE, Contract, Reference
from plantmart.functions.casts import malformed, overlong
from plantmart.operators.joins import BROADCAST_BYTES, BROADCAST_TOTAL, check_key_types, parent_keys
from plantmart.operators.merge import union_all

REQUIRED = "not null"
ALLOWED = "allowed values"
SOURCE_KNOWN = "known source"
OVERLONG = "length"
MALFORMED_NUMBER = "malformed"
UNIQUE = "unique key"
REFERENCE = "reference"

Rule = tuple[str, str, Column]


def typed_rules(contract: Contract, plants: Sequence[str] = PLANTS) -> list[Rule]:
    """(rule, column, violated) for typed rows. NULL passes an allowed-values check."""
    rules: list[Rule] = [(REQUIRED, c, F.col(c).isNull()) for c in contract.required]
    for column, values in contract.allowed:
        rules.append((ALLOWED, column, F.coalesce(~F.col(column).isin(*values), F.lit(False))))
    unknown = F.col(SOURCE).isNull() | ~F.col(SOURCE).isin(*plants)
    rules.append((SOURCE_KNOWN, SOURCE, unknown))
    return rules


def raw_rules(contract: Contract) -> list[Rule]:
    """(rule, column, violated) for raw text: what the casts would cut or fail on."""
    rules: list[Rule] = [
        (OVERLONG, c.name, overlong(c)) for c in contract.columns if c.length is not None
    ]
    return rules + [
        (MALFORMED_NUMBER, c.name, malformed(c)) for c in contract.columns if c.kind != "text"
    ]


def count_violations(rows: DataFrame, table: str, rules: Sequence[Rule]) -> DataFrame:
    """All rules of a table in one pass: (table_name, rule, column_name, source, violations)."""
    counted = rows.groupBy(SOURCE).agg(
        *[F.count_if(violated).alias(f"v{i}") for i, (_, _, violated) in enumerate(rules)]
    )
    cells = [
        F.struct(
            F.lit(rule).alias("rule"),
            F.lit(column).alias("column_name"),
            F.col(f"v{i}").alias("violations"),
        )
        for i, (rule, column, _) in enumerate(rules)
    ]
    return counted.select(SOURCE, F.inline(F.array(*cells))).select(
        F.lit(table).alias("table_name"), "rule", "column_name", SOURCE, "violations"
    )


def check_rows(typed: DataFrame, contract: Contract, plants: Sequence[str] = PLANTS) -> DataFrame:
    return count_violations(typed, contract.name, typed_rules(contract, plants))


def check_raw(raw: DataFrame, contract: Contract) -> DataFrame:
    return count_violations(raw, contract.name, raw_rules(contract))


def duplicate_keys(typed: DataFrame, key: Sequence[str], per_source: bool = True) -> DataFrame:
    """Key values that occur more than once, by default within one source, with their row count."""
    columns = [*key, SOURCE] if per_source else list(key)
    return typed.groupBy(*columns).agg(F.count("*").alias("copies")).filter(F.col("copies") > 1)


def reference_pairs(reference: Reference, per_source: bool = True) -> list[tuple[str, str]]:
    pairs = list(zip(reference.columns, reference.parent_columns))
    return pairs + [(SOURCE, SOURCE)] if per_source else pairs


def check_keys(typed: DataFrame, contract: Contract) -> DataFrame:
    """Surplus rows per source, as one violation count for the whole key."""
    keys = typed.groupBy(*contract.key, SOURCE).agg(F.count("*").alias("copies"))
    surplus = keys.groupBy(SOURCE).agg(F.sum(F.col("copies") - 1).alias("violations"))
    return surplus.select(
        F.lit(contract.name).alias("table_name"),
        F.lit(UNIQUE).alias("rule"),
        F.lit(", ".join(contract.key)).alias("column_name"),
        SOURCE,
        "violations",
    )


def reference_name(reference: Reference) -> str:
    return ", ".join(reference.columns) + " -> " + reference.parent


def _with_parent(child: DataFrame, parent: DataFrame, reference: Reference, per_source: bool, flag: str, small: bool):
    """The rows with a flag that is set where the parent holds their key; no row is added or lost."""
    pairs = reference_pairs(reference, per_source)
    check_key_types(child, parent, pairs)
    names = {f"_parent_{i}": f"{flag}_{i}" for i in range(len(pairs))}
    parents = parent_keys(parent, pairs).withColumnsRenamed(names).withColumn(flag, F.lit(True))
    parents = F.broadcast(parents) if small else parents
    same = [F.col(lc) == F.col(name) for (lc, _), name in zip(pairs, names.values())]
    return child.join(parents, same, "left").drop(*names.values())


def _is_orphan(reference: Reference, flag: Column, per_source: bool = True) -> Column:
    """True for a complete key that the parent lacks; a key with a NULL part refers to nothing."""
    present = F.lit(True)
    for column in (*reference.columns, *((SOURCE,) if per_source else ())):
        present = present & F.col(column).isNotNull()
    return present & flag.isNull()


def check_reference(
    child: DataFrame, parent: DataFrame, table: str, reference: Reference, per_source: bool = True
) -> DataFrame:
    """Child rows per source that refer to a missing parent; for a parent of any size.

    Each key value of the child meets each key value of the parent once, with its row count and its source,
    so neither side has a hot key.
    """
    keyed = _keys_within_sources if per_source else _keys_of_all_sources
    return (
        keyed(child, parent, reference)
        .groupBy(SOURCE)
        .agg(F.sum(F.when(F.col("_orphan"), F.col("child_rows")).otherwise(0)).alias("violations"))
        .select(
            F.lit(table).alias("table_name"),
            F.lit(REFERENCE).alias("rule"),
            F.lit(reference_name(reference)).alias("column_name"),
            SOURCE,
            "violations",
        )
    )


def _keys_within_sources(child: DataFrame, parent: DataFrame, reference: Reference) -> DataFrame:
    """Source, child_rows and _orphan of each key value of the child. One aggregate of both sides: no join, no sort."""
    pairs = reference_pairs(reference)
    check_key_types(child, parent, pairs)
    names = [f"_key_{i}" for i in range(len(pairs))]
    rows = child.select(*[F.col(c).alias(n) for (c, _), n in zip(pairs, names)], F.lit(1).alias("_rows"), F.lit(False).alias("_held"))
    held = parent.select(*[F.col(c).alias(n) for (_, c), n in zip(pairs, names)], F.lit(0), F.lit(True))
    keys = rows.union(held).groupBy(*names).agg(F.sum("_rows").alias("child_rows"), F.max("_held").alias("_held"))
    orphan = ~F.col("_held")
    for name in names:
        orphan = orphan & F.col(name).isNotNull()
    return keys.where("child_rows > 0").select(F.col(names[-1]).alias(SOURCE), "child_rows", orphan.alias("_orphan"))


def _keys_of_all_sources(child: DataFrame, parent: DataFrame, reference: Reference) -> DataFrame:
    """The same where a key may be held by any source of the parent."""
    columns = list(dict.fromkeys([*reference.columns, SOURCE]))
    keys = child.groupBy(*columns).agg(F.count("*").alias("child_rows"))
    joined = _with_parent(keys, parent, reference, False, "_held", small=False)
    return joined.select(SOURCE, "child_rows", _is_orphan(reference, F.col("_held"), False).alias("_orphan"))


def check_table(
    rows: DataFrame,
    contract: Contract,
    parents: Mapping[Reference, DataFrame | None],
    plants: Sequence[str] = PLANTS,
) -> DataFrame:
    """Row rules, and references to parents that are small or missing, in one pass over the rows.

    A reference to a parent that does not exist (None) is broken by every row with a complete key.
    """
    joined, rules = rows, typed_rules(contract, plants)
    for i, (reference, parent) in enumerate(parents.items()):
        flag = f"_held{i}"
        if parent is None:
            joined = joined.withColumn(flag, F.lit(None).cast("boolean"))
        else:
            joined = _with_parent(joined, parent, reference, True, flag, small=True)
        rules.append((REFERENCE, reference_name(reference), _is_orphan(reference, F.col(flag))))
    return count_violations(joined, contract.name, rules)


def _of_sources(rows: DataFrame | None, sources: Sequence[str] | None) -> DataFrame | None:
    return rows if rows is None or sources is None else rows.where(F.col(SOURCE).isin(list(sources)))


def check_tables(
    tables: Mapping[str, DataFrame],
    contracts: Mapping[str, Contract],
    plants: Sequence[str] = PLANTS,
    size_of: Callable[[str, Sequence[str]], int | None] = lambda table, columns: None,
    only: Mapping[str, Sequence[str] | None] | None = None,
) -> DataFrame:
    """Every row, key and reference check of the given typed tables as one DataFrame.

    ``size_of`` gives a known upper bound of the size of some columns of a table. Parents whose keys
    are within the limits for broadcasting are checked together with the row rules; each other one
    takes a pass of its own. Parents that were never published are missing, not left out.

    ``only`` names the tables to check and their sources (None: all of them). Parents are read for these
    sources alone too, since keys and references hold within a source.
    """
    found = []
    for name in tables if only is None else only:
        contract = contracts[name]
        sources = None if only is None else only[name]
        rows = _of_sources(tables[name], sources)
        together: dict[Reference, DataFrame | None] = {}
        room = BROADCAST_BYTES * BROADCAST_TOTAL
        for reference in contract.references:
            parent = _of_sources(tables.get(reference.parent), sources)
            size = None if parent is None else size_of(reference.parent, [*reference.parent_columns, SOURCE])
            if parent is None:
                together[reference] = None
            elif size is not None and size <= min(BROADCAST_BYTES, room):
                together[reference] = parent
                room -= size
            else:
                found.append(check_reference(rows, parent, name, reference))
        found.append(check_table(rows, contract, together, plants))
        if contract.key:
            found.append(check_keys(rows, contract))
    return union_all(found)


def rows_per_source(typed: DataFrame, table: str, plants: Sequence[str] = PLANTS) -> DataFrame:
    """Row count per source, with the rows whose source is unknown."""
    unknown = F.col(SOURCE).isNull() | ~F.col(SOURCE).isin(*plants)
    return (
        typed.groupBy(SOURCE)
        .agg(F.count("*").alias("row_count"), F.count_if(unknown).alias("unknown_source_rows"))
        .select(F.lit(table).alias("table_name"), SOURCE, "row_count", "unknown_source_rows")
    )


def schema_differences(actual: T.StructType, expected: T.StructType) -> list[tuple[str, str, str]]:
    """(column, problem, detail) for missing, extra and differently typed columns.

    Names compare without regard to case, and the audit columns count like any other.
    """
    have = {f.name.lower(): f.dataType.simpleString() for f in actual.fields}
    want = {f.name.lower(): f.dataType.simpleString() for f in expected.fields}
    found = [(c, "missing", t) for c, t in want.items() if c not in have]
    found += [(c, "extra", t) for c, t in have.items() if c not in want]
    found += [
        (c, "type", f"{have[c]} instead of {t}")
        for c, t in want.items()
        if c in have and have[c] != t
    ]
    return found


def undeclared_columns(raw: DataFrame, contract: Contract) -> list[str]:
    declared = set(contract.raw_names) | {SOURCE, LOADED_AT}
    return [c for c in raw.columns if c not in declared]
