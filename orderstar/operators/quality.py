"""Reports on rows that break the declared constraints.

Unique keys, references and columns that must not be NULL are checked together: every table is read
once, its rows become cases of the rules that concern them, and equal cases are counted in a single
aggregation. A value that fills a third of a fact table reaches the shuffle as one row per task.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple, Protocol

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import FOREIGN_KEYS, NOT_NULL, TABLES, UNIQUE_KEYS
from ..session import checkpointed, few_rows


class Tables(Protocol):
    """Anything that gives a table by name: a warehouse, or a dict of frames."""

    def __getitem__(self, name: str) -> DataFrame: ...


class Rule(NamedTuple):
    """A constraint, and what the report on it calls it."""

    kind: str  # unique, foreign or required
    table: str
    columns: list[str]
    parent: tuple[str, str] | None = None

    @property
    def name(self) -> str:
        return f"{self.table}.{self.columns[0]}"


def rules(unique=(), foreign=(), required=None) -> list[Rule]:
    found = [Rule("unique", table, list(key)) for table, key in unique]
    found += [Rule("foreign", child, [column], (parent, key)) for child, column, parent, key in foreign]
    for table, columns in (required or {}).items():
        found += [Rule("required", table, [column]) for column in columns]
    return found


ALL_RULES = rules(UNIQUE_KEYS, FOREIGN_KEYS, NOT_NULL)

# What a case is about: a number, or one or two texts; a constant for columns that must not be NULL.
_VALUE = {"number": "bigint", "text": "string", "more": "string"}


def _value(table: str, columns: list[str]) -> dict[str, str]:
    """The columns of a key in the slots of a case; kinds that have no slot are shown as text."""
    if len(columns) > 2:
        raise ValueError(f"a key of {table} has more than two columns: {', '.join(columns)}")
    if [TABLES[table][column] for column in columns] == ["bigint"]:
        return {"number": columns[0]}
    return dict(zip(("text", "more"), (f"CAST({column} AS string)" for column in columns)))


def _cases(table: str, checked: list[Rule]) -> list[tuple[int, str, dict[str, str], bool]]:
    """Rules that concern the rows of a table: which, when, by which value, and whether as parent."""
    found = []
    for i, rule in enumerate(checked):
        if rule.table == table and rule.kind == "required":
            found.append((i, f"{rule.columns[0]} IS NULL", {}, False))
        elif rule.table == table:
            given = " AND ".join(f"{column} IS NOT NULL" for column in rule.columns)
            found.append((i, given, _value(table, rule.columns), False))
        if rule.parent and rule.parent[0] == table:
            key = rule.parent[1]
            found.append((i, f"{key} IS NOT NULL", _value(table, [key]), True))
    return found


def counted_cases(tables: Tables, checked: list[Rule]) -> DataFrame:
    """(rule, value in its slots, rows, parents): how often each different case occurs."""
    concerned = dict.fromkeys(t for r in checked for t in (r.table, *(r.parent or ())[:1]))
    cases = {table: _cases(table, checked) for table in concerned}
    # Slots that no rule needs would only widen the rows.
    slots = [s for s in _VALUE if any(s in value for own in cases.values() for _, _, value, _ in own)]
    stacked = []
    for table, own in cases.items():
        rows = [
            ", ".join(
                [f"IF({given}, {i}, NULL)"]
                + [value.get(s, f"CAST(NULL AS {_VALUE[s]})") for s in slots]
                + [f"{int(not parent)}L", f"{int(parent)}L"]
            )
            for i, given, value, parent in own
        ]
        names = ", ".join(["rule", *slots, "child", "parent"])
        stacked.append(
            tables[table].selectExpr(f"stack({len(rows)}, {', '.join(rows)}) AS ({names})")
        )
    return (
        reduce(DataFrame.unionByName, stacked)
        .filter("rule IS NOT NULL")
        .groupBy("rule", *slots)
        .agg(F.sum("child").alias("rows"), F.sum("parent").alias("parents"))
    )


def _ids(checked: list[Rule], kind: str) -> list[int]:
    return [i for i, rule in enumerate(checked) if rule.kind == kind]


def broken(cases: DataFrame, checked: list[Rule]) -> DataFrame:
    """The cases that break their rule."""
    bad = {"unique": "rows > 1", "foreign": "rows > 0 AND parents = 0", "required": "rows > 0"}
    given = {kind: ", ".join(map(str, _ids(checked, kind))) for kind in bad}
    return cases.filter(
        " OR ".join(f"rule IN ({given[kind]}) AND {test}" for kind, test in bad.items() if given[kind])
    )


def _named(checked: list[Rule], name: str) -> str:
    values = {
        "table_name": [rule.table for rule in checked],
        "column_name": [rule.columns[0] for rule in checked],
        "fk_name": [rule.name for rule in checked],
    }[name]
    listed = ", ".join(f"'{value}'" for value in values)
    return f"element_at(array({listed}), rule + 1) AS {name}"


def _summed(found: DataFrame, checked: list[Rule], kind: str, total: str) -> DataFrame:
    """Rows that break each rule of a kind; rules that hold are listed with zero."""
    ids = _ids(checked, kind)
    none = few_rows(
        found.sparkSession, [{"rule": i, "rows": 0} for i in ids], "rule: int, rows: bigint"
    )
    own = found.filter(F.col("rule").isin(ids)).select("rule", "rows")
    return own.unionByName(none).groupBy("rule").agg(F.sum("rows").alias(total))


def _duplicates(found: DataFrame, checked: list[Rule]) -> DataFrame:
    slots = ", ".join(f"CAST({c} AS string)" for c in _VALUE if c in found.columns)
    return found.filter(F.col("rule").isin(_ids(checked, "unique"))).selectExpr(
        _named(checked, "table_name"), f"concat_ws('|', {slots}) AS key_value", "rows AS dup_cnt"
    )


def _orphans(found: DataFrame, checked: list[Rule]) -> DataFrame:
    summed = _summed(found, checked, "foreign", "orphan_rows")
    return summed.selectExpr(_named(checked, "fk_name"), "orphan_rows")


def _nulls(found: DataFrame, checked: list[Rule]) -> DataFrame:
    names = (_named(checked, name) for name in ("table_name", "column_name"))
    return _summed(found, checked, "required", "null_rows").selectExpr(*names, "null_rows")


def _report(tables: Tables, checked: list[Rule], shown) -> DataFrame:
    return shown(broken(counted_cases(tables, checked), checked), checked)


def pk_duplicates(tables: Tables, keys=UNIQUE_KEYS) -> DataFrame:
    """Key values that occur more than once where the model declares them unique."""
    return _report(tables, rules(unique=keys), _duplicates)


def fk_orphans(tables: Tables, keys=FOREIGN_KEYS) -> DataFrame:
    """Rows per foreign key whose non-null value has no parent row.

    Child rows and parent keys meet as cases of one rule, so there is no join.
    """
    return _report(tables, rules(foreign=keys), _orphans)


def null_violations(tables: Tables, columns=NOT_NULL) -> DataFrame:
    """NULLs per column declared NOT NULL: plain counts, so no case is shuffled."""

    def nulls(table: str, names: list[str]) -> DataFrame:
        return (
            tables[table]
            .agg(*(F.count_if(F.col(name).isNull()).alias(name) for name in names))
            .unpivot([], names, "column_name", "null_rows")
            .select(F.lit(table).alias("table_name"), "column_name", "null_rows")
        )

    return reduce(DataFrame.unionByName, (nulls(table, names) for table, names in columns.items()))


def constraint_reports(tables: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Duplicates, NULLs and orphans together: one pass over all tables, the findings stored."""
    found = checkpointed(broken(counted_cases(tables, ALL_RULES), ALL_RULES))
    return tuple(shown(found, ALL_RULES) for shown in (_duplicates, _nulls, _orphans))


def upsert_conflicts(staged: DataFrame) -> DataFrame:
    """Ids that arrive with more than one phone in the same batch."""

    def variants(table: str, key: str, attribute: str) -> DataFrame:
        return (
            staged.filter(F.col(key).isNotNull())
            .select(key, attribute)
            .distinct()
            .groupBy(key)
            .agg(F.count("*").alias("variant_cnt"))
            .filter(F.col("variant_cnt") > 1)
            .select(
                F.lit(table).alias("table_name"),
                F.col(key).cast("string").alias("key_value"),
                "variant_cnt",
            )
        )

    return variants("dim_user", "user_id", "user_phone").unionByName(
        variants("dim_driver", "driver_id", "driver_phone")
    )
