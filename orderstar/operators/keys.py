"""Dense keys and ranks that never put a whole table, or a whole group, in one task.

Both rest on the same step: sort globally (range partitions), number the rows where they lie, store
them, and add to each row what the partitions before it hold. Only one or two rows per partition are
ever counted up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpointed, few_rows, freed_shuffles, gathered

# monotonically_increasing_id(): partition number above this bit, row number below.
_ROW_BITS = 33


def _placed(rows: DataFrame, order: list[Column]) -> DataFrame:
    """Globally sorted rows with the partition and the position they got.

    Has to be stored within one job: another one may cut the partitions elsewhere.
    """
    at = F.col("_at")
    return rows.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()).select(
        *rows.columns,
        F.shiftright(at, _ROW_BITS).alias("_part"),
        at.bitwiseAND((1 << _ROW_BITS) - 1).alias("_row"),
    )


def with_dense_key(rows: DataFrame, key: str, order_by: list[str]) -> DataFrame:
    """Number rows 1..N in the order of their (unique) natural key.

    Text sorts by UTF-8 bytes, so equal input always gets equal keys.
    """
    placed = checkpointed(_placed(rows, [F.col(c).asc() for c in order_by]))
    # One row per partition, so the unpartitioned window and the broadcast stay small.
    before = (
        placed.groupBy("_part")
        .agg(F.count("*").alias("_size"))
        .select(
            "_part",
            F.coalesce(
                F.sum("_size").over(
                    Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
                ),
                F.lit(0),
            ).alias("_before"),
        )
    )
    return placed.join(F.broadcast(before), "_part").select(
        (F.col("_before") + F.col("_row") + 1).alias(key), *rows.columns
    )


_KINDS = ("g", "r")  # groups, and in them runs of equal values


def _edges(measured: DataFrame, group: list[str], value: str) -> DataFrame:
    """Per partition: its rows, those before it, and how its edge groups and runs go on elsewhere.

    Partitions are sorted one after the other, so only the group (``g``) and the run of equal values
    (``r``) a partition begins or ends with can have rows in others. ``first`` is the global number of
    the first row of what the partition begins with, ``head`` and ``tail`` are the whole sizes.
    """
    sizes = measured.groupBy("_part").agg((F.max("_row") + 1).alias("_rows"))
    is_edge = (F.col("_row") == 0) | (F.col("_row") == F.col("_rows") - 1)
    found = measured.join(F.broadcast(sizes), "_part").filter(is_edge)
    rows = sorted(found.collect(), key=lambda row: (row["_part"], row["_row"]))  # two a partition
    keys = {"g": group, "r": [*group, value]}
    parts: dict[int, dict] = {}
    spans: dict[str, list[list]] = {kind: [] for kind in _KINDS}  # pieces that belong together
    before, last = 0, {}
    for row in rows:
        part = row["_part"]
        if part not in parts:
            parts[part] = {"_part": part, "_rows": row["_rows"], "_before": before}
            before += row["_rows"]
        for kind in _KINDS:
            begin, end = row[f"_from_{kind}"], row[f"_to_{kind}"]
            piece = (part, begin, end - begin + 1)
            key = tuple(row[c] for c in keys[kind])
            if key != last.get(kind):
                spans[kind].append([piece])
            elif spans[kind][-1][-1] != piece:
                spans[kind][-1].append(piece)
            last[kind] = key
    for kind in _KINDS:
        for span in spans[kind]:
            start, size = parts[span[0][0]]["_before"] + span[0][1] + 1, sum(s for _, _, s in span)
            for part, begin, own in span:
                if begin == 0:
                    parts[part] |= {f"_first_{kind}": start, f"_head_{kind}": size}
                if begin + own == parts[part]["_rows"]:
                    parts[part][f"_tail_{kind}"] = size
    names = [f"_{at}_{kind}" for kind in _KINDS for at in ("first", "head", "tail")]
    schema = ", ".join(f"{name}: bigint" for name in ["_part", "_rows", "_before", *names])
    return few_rows(measured.sparkSession, list(parts.values()), schema)


def two_way_ranks(
    rows: DataFrame, group: list[str], value: str, tie: str, down: str, up: str
) -> DataFrame:
    """Rank rows, no two alike in (group, value, tie), from both ends of ``value`` (an exact number).

    ``down`` starts at the largest value (NULL before all), ``up`` at the smallest (NULL last); within
    a value both go by ``tie`` ascending, NULL last. Rows are sorted once: in the other direction the
    runs of equal values change places and keep their inner order, so a row's second rank follows from
    where its run begins, how long it is, and the size of the group. Groups and runs are measured
    inside a range partition, and stored; what a partition begins or ends with is completed from the
    others.
    """
    # Groups may come in any order: sorted by a number first, their columns are hardly ever compared.
    in_group = ["_group", *group]
    numbered = rows.withColumn("_group", F.xxhash64(*group))
    order = [*(F.col(c) for c in in_group), F.desc_nulls_first(value), F.asc_nulls_last(tie)]
    measured, row = _placed(gathered(numbered, "_group"), order), F.col("_row")
    # A window never holds more than one partition's share of a group; both need one shuffle.
    windows = {
        "r": Window.partitionBy(*in_group, "_part", value),
        "g": Window.partitionBy(*in_group, "_part"),
    }
    for kind, window in windows.items():
        measured = measured.withColumns(
            {f"_from_{kind}": F.min(row).over(window), f"_to_{kind}": F.max(row).over(window)}
        )
    with freed_shuffles(rows.sparkSession):
        measured = checkpointed(measured)
    edges = _edges(measured, group, value)
    first, size = {}, {}
    for kind in _KINDS:
        begin, end = F.col(f"_from_{kind}"), F.col(f"_to_{kind}")
        at_head, at_tail = begin == 0, end == F.col("_rows") - 1
        first[kind] = F.when(at_head, F.col(f"_first_{kind}")).otherwise(F.col("_before") + begin + 1)
        size[kind] = (
            F.when(at_head, F.col(f"_head_{kind}"))
            .when(at_tail, F.col(f"_tail_{kind}"))
            .otherwise(end - begin + 1)
        )
    place = F.col("_before") + row + 1
    behind = first["g"] + size["g"] - first["r"] - size["r"]  # rows of the group behind the run
    return measured.join(F.broadcast(edges), "_part").select(
        *rows.columns,
        (place - first["g"] + 1).alias(down),
        (behind + place - first["r"] + 1).alias(up),
    )
