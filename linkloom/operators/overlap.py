"""Records that share terms, met by classes: records with equal terms are one class, classes meet in cells, and members come back at the end.

A cell is a part of the clean classes against a part of the candidates' classes. In it the shared terms of a class with all others are one
count over posting lists of small integers, where a join would make and shuffle a row for each shared term.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Classes of either side in a cell; fewer where a cell returns all pairs, which bounds what it returns.
CELL, CELL_ALL = 16_384, 2_048
#: Cells for each core at least, so that tasks even out.
CELLS_PER_CORE = 3


def heaviest(shared: np.ndarray, sizes: np.ndarray, top: int) -> np.ndarray:
    """Places of the classes that may have one of the top records, most shared terms first, ties by id. Classes stand in the order of their
    smallest ids: of the count at which top is reached, as many classes as records are open, since each has a record before any later class."""
    levels = np.bincount(shared, weights=sizes)
    above = np.append(np.cumsum(levels[::-1])[::-1], 0)[1:]  # records that share more
    if above[0] < top:
        return np.arange(len(shared))
    last = int(np.flatnonzero(above < top)[0])
    tied = np.flatnonzero(shared == last)[: top - int(above[last])]
    return np.concatenate([np.flatnonzero(shared > last), tied])


def shared_terms(left: DataFrame, right: DataFrame, cap: int, least: int = 1, top: int | None = None) -> DataFrame:
    """(l, r, shared): classes that share at least `least` terms, of terms that at most cap candidates hold.

    left: (l, terms); right: (r, n, terms), distinct terms, n candidates, r the smallest id. With top each cell leaves out classes that can't be among the top
    candidates of a clean record.
    """
    held = right.select("n", F.explode("terms").alias("term")).where(F.col("term") != "").groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") <= cap).select("term")
    mine = left.select("l", F.explode("terms").alias("term")).join(held, "term").groupBy("l").agg(F.collect_list("term").alias("terms"))
    cell = CELL if top else CELL_ALL
    cores = left.sparkSession.sparkContext.defaultParallelism
    across = max(1, -(-right.count() // cell))
    down = max(1, -(-left.count() // cell), -(-CELLS_PER_CORE * cores // across))

    def dealt(df: DataFrame, key: str, own: int, other: int, number) -> DataFrame:
        part = F.pmod(F.xxhash64(key), F.lit(own))
        return df.withColumn("cell", F.explode(F.transform(F.sequence(F.lit(0), F.lit(other - 1)), lambda o: number(part, o)))).repartition(down * across, "cell")

    def met(a: pa.Table, b: pa.Table) -> pa.Table:
        names, ids, found = [], [], []
        if a.num_rows and b.num_rows:
            b = b.take(pc.sort_indices(b["r"]))
            x, y = pa.concat_arrays(a["terms"].chunks), pa.concat_arrays(b["terms"].chunks)
            codes = pa.concat_arrays([x.flatten(), y.flatten()]).dictionary_encode()
            places, n_terms = codes.indices.to_numpy(zero_copy_only=False), len(codes.dictionary)
            ends, sizes = np.append(0, np.cumsum(pc.list_value_length(x).to_numpy(zero_copy_only=False))), b["n"].to_numpy()
            own, theirs = places[: ends[-1]], places[ends[-1] :]
            holder = np.repeat(np.arange(len(y)), pc.list_value_length(y).to_numpy(zero_copy_only=False))
            wanted = np.isin(theirs, own)
            theirs, holder = theirs[wanted], holder[wanted]
            order = np.argsort(theirs, kind="stable")
            holder, start = holder[order], np.searchsorted(theirs[order], np.arange(n_terms + 1))
            for i in range(len(x)):
                lists = [holder[start[t] : start[t + 1]] for t in own[ends[i] : ends[i + 1]]]
                count = np.bincount(np.concatenate(lists), minlength=len(y)) if lists else np.zeros(0, dtype=np.int64)
                hits = np.flatnonzero(count >= least)
                if top and len(hits):
                    hits = hits[heaviest(count[hits], sizes[hits], top)]
                names.append(np.full(len(hits), i))
                ids.append(hits)
                found.append(count[hits])
        if not names:
            return pa.table({"l": pa.array([], pa.string()), "r": pa.array([], pa.string()), "shared": pa.array([], pa.int64())})
        return pa.table({"l": a["l"].take(pa.array(np.concatenate(names))), "r": b["r"].take(pa.array(np.concatenate(ids))), "shared": pa.array(np.concatenate(found).astype(np.int64))})

    one = dealt(mine, "l", down, across, lambda p, o: p * F.lit(across) + o).groupBy("cell")
    two = dealt(right.select("r", "n", "terms"), "r", across, down, lambda p, o: o * F.lit(across) + p).groupBy("cell")
    return one.cogroup(two).applyInArrow(met, "l string, r string, shared bigint")


def classes(records: DataFrame, columns: list[str], name: str) -> DataFrame:
    """The distinct values of columns, each with its smallest id (column name) and n, its records."""
    return records.groupBy(*columns).agg(F.min("entity_id").alias(name), F.count(F.lit(1)).alias("n"))


def expanded(pairs: DataFrame, weight: Column, left: DataFrame, right: DataFrame, own: list[str], theirs: list[str], top: int) -> DataFrame:
    """The heaviest candidates of each clean record, ties by id, with rank from 0, from pairs of classes: their own columns, rid, gid, source, rank.

    left: rid and the columns own that name its class; right: gid, source and theirs. A class passes on its first top members by id at most. Clean
    records of a class share one list.
    """
    first = Window.partitionBy(*theirs).orderBy("gid")
    members = right.select(*theirs, "gid", "source").distinct().withColumn("_k", F.row_number().over(first)).where(F.col("_k") <= top).drop("_k")
    order = Window.partitionBy(*own).orderBy(F.desc("_w"), "gid")
    listed = pairs.withColumn("_w", weight).join(members, theirs).withColumn("_k", F.row_number().over(order)).where(F.col("_k") <= top)
    return listed.withColumn("rank", F.col("_k") - 1).drop("_w", "_k").join(left.select(*own, "rid").distinct(), own)


def once(pairs: DataFrame, columns: list[str], **scores: Column) -> DataFrame:
    """pairs with scores that depend on columns alone, each made once for a distinct value of these."""
    return pairs.join(pairs.select(*columns).distinct().select("*", *[v.alias(k) for k, v in scores.items()]), columns)
