"""Vector codes by member-resident Lloyd rounds.

Vectors are cut into equal consecutive parts; each position of a part has a codebook, and a vector's
code is the index of the nearest entry at each position. Rows of the working table are parts. A part
lives with its owner ``(position, entry, salt)``: it is shuffled there once, and from then on stays in
the files of that owner while its nearest entry stays the same. A round has two passes:

* owners add up their resident members, one row per entry and task, and the sums make the new entries
  (a table of fixed size, all that reaches the driver and is sent back);
* residents look for their nearest new entry. Those that keep it are written where they are, without
  a shuffle; those that change it are shuffled to their new owner and written beside its residents.

An entry with many members has several salts, as many as its measured count asks for, so one that
holds a third of all parts is spread as evenly as the others. Every table is in the shared folder and
the previous one is dropped when its successor is complete.

Arithmetic is exact: in doubles or 64-bit integers while the largest component proves that no sum can
leave them, else in Python's integers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelmend.llm.common import Scratch

PARTS = 4
ENTRIES = 256
ROUNDS = 4
SCALE = 1024
#: Parts compared with all entries of their position at a time.
SLICE = 4096


def usable(vector: Column) -> Column:
    """Not null, not empty, without null or non-finite components."""
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(
        vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


@dataclass(frozen=True)
class Cut:
    """How vectors become parts: components per part, and the arithmetic that holds their sums."""

    width: int
    kind: str  # numpy's float64, int64 or object
    parts: int = PARTS

    @staticmethod
    def of(size: int, largest: float, parts: int = PARTS) -> "Cut":
        width, top = size // parts, int(largest) * SCALE + SCALE
        # squares of differences of two components, added up over a part
        most = 4 * top * top * width
        kind = "float64" if most < 1 << 53 else "int64" if most < 1 << 62 else "object"
        return Cut(width, kind, parts)

    @property
    def column(self) -> T.DataType:
        return T.ArrayType(T.StringType() if self.kind == "object" else T.LongType())

    def integers(self, x: np.ndarray) -> np.ndarray:
        """floor(1024 x); a multiple of a power of two, so nothing is rounded."""
        if self.kind != "object":
            return np.floor(x * SCALE).astype(self.kind)
        with np.errstate(over="ignore"):
            y = np.floor(x * SCALE)
        out = np.empty(x.shape, dtype=object)
        out.reshape(-1)[:] = [int(b) if np.isfinite(b) else int(a) * SCALE
                              for a, b in zip(x.reshape(-1).tolist(), y.reshape(-1).tolist())]
        return out

    def read(self, column: pa.Array) -> np.ndarray:
        flat = column.flatten()
        if self.kind == "object":
            out = np.empty(len(flat), dtype=object)
            out[:] = [int(x) for x in flat.to_pylist()]
        else:
            out = flat.to_numpy(zero_copy_only=False).astype(self.kind)
        return out.reshape(-1, self.width)

    def write(self, x: np.ndarray) -> pa.Array:
        flat = x.reshape(-1)
        flat = (pa.array([str(v) for v in flat.tolist()], pa.string()) if self.kind == "object"
                else pa.array(flat.astype(np.int64)))
        return pa.ListArray.from_arrays(
            pa.array(np.arange(0, x.size + 1, self.width, dtype=np.int32)), flat)

    def book(self, entries: list[list[int]]) -> np.ndarray:
        out = np.empty((len(entries), self.width), dtype=object)
        for i, entry in enumerate(entries):
            out[i, :] = entry
        return out.astype(self.kind)


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry of each part (ties to the lower one) and the squared distance."""
    best = np.empty(len(parts), dtype=np.int64)
    away = np.empty(len(parts), dtype=parts.dtype)
    squares = (entries * entries).sum(axis=1)
    for at in range(0, len(parts), SLICE):
        some = parts[at:at + SLICE]
        far = squares[None, :] - 2 * (some @ entries.T)
        found = far.argmin(axis=1).astype(np.int64)
        best[at:at + SLICE] = found
        away[at:at + SLICE] = far[np.arange(len(some)), found] + (some * some).sum(axis=1)
    return best, away


def _salts(rows: np.ndarray, positions: np.ndarray, entries: np.ndarray, salts: np.ndarray) -> np.ndarray:
    mixed = rows.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return ((mixed >> np.uint64(33)).astype(np.int64) % salts[positions, entries]).astype(np.int32)


def _cut(cut: Cut, books: list[list[list[int]]]):
    """Vectors to parts, each with its nearest entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [cut.book(b) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            x = cut.integers(flat.reshape(batch.num_rows, -1))
            for p in range(cut.parts):
                part = np.ascontiguousarray(x[:, p * cut.width:(p + 1) * cut.width])
                entry, _ = nearest(part, tables[p])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(part), p, np.int32)), pa.array(entry.astype(np.int32)),
                     batch.column(0), cut.write(part)], names=["position", "entry", "row", "part"])
    return run


def _assign(cut: Cut, books: list[list[list[int]]], salts: np.ndarray | None):
    """Residents with their nearest entry; with ``salts`` the owner, else the distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = [cut.book(b) for b in books]
        for batch in batches:
            if not batch.num_rows:
                continue
            position, old = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            parts = cut.read(batch.column(3))
            entry = np.zeros(len(old), dtype=np.int64)
            away = np.zeros(len(old), dtype=parts.dtype)
            for p in np.unique(position):
                at = np.flatnonzero(position == p)
                entry[at], away[at] = nearest(parts[at], tables[p])
            new = pa.array(entry.astype(np.int32))
            if salts is None:
                fits = [int(v) if v < 1 << 63 else None for v in away.tolist()]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), new, batch.column(2), pa.array(fits, pa.int64())],
                    names=["position", "entry", "row", "away"])
                continue
            rows = batch.column(2).to_numpy()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), new, batch.column(2), batch.column(3),
                 pa.array(_salts(rows, position, entry, salts)), pa.array(entry != old)],
                names=["position", "entry", "row", "part", "salt", "moved"])
    return run


def _sums(cut: Cut):
    """What one task's residents add to each entry."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = object if cut.kind == "object" else np.int64
        total = np.zeros((cut.parts * ENTRIES, cut.width), dtype=kind)
        count = np.zeros(cut.parts * ENTRIES, dtype=np.int64)
        for batch in batches:
            owner = batch.column(0).to_numpy().astype(np.int64) * ENTRIES + batch.column(1).to_numpy()
            np.add.at(total, owner, cut.read(batch.column(2)).astype(kind))
            count += np.bincount(owner, minlength=len(count))
        at = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [pa.array(at.astype(np.int32)), pa.array(count[at]),
             pa.array([[str(v) for v in total[i].tolist()] for i in at], pa.list_(pa.string()))],
            names=["owner", "n", "total"])
    return run


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of all tasks for the owners dealt to this one; at most one row for each entry."""
    count: dict[int, int] = {}
    total: dict[int, list[int]] = {}
    for batch in batches:
        for owner, n, some in zip(*(batch.column(i).to_pylist() for i in range(3))):
            count[owner] = count.get(owner, 0) + n
            new = [int(v) for v in some]
            total[owner] = [a + b for a, b in zip(total[owner], new)] if owner in total else new
    yield pa.RecordBatch.from_arrays(
        [pa.array(list(count), pa.int32()), pa.array(list(count.values()), pa.int64()),
         pa.array([[str(v) for v in total[o]] for o in count], pa.list_(pa.string()))],
        names=["owner", "n", "total"])


_SUMS = "owner int, n long, total array<string>"


def _update(residents: DataFrame, cut: Cut, books: list[list[list[int]]]):
    """New entries from the members' sums, and the members of each entry."""
    slots = int(residents.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    sums = (residents.select("position", "entry", "part").mapInArrow(_sums(cut), _SUMS)
            .repartition(slots, "owner").mapInArrow(_merged, _SUMS).collect())
    new = [[list(e) for e in book] for book in books]
    members = np.zeros((cut.parts, ENTRIES), dtype=np.int64)
    for r in sums:  # one row per entry at most
        p, e = divmod(r["owner"], ENTRIES)
        members[p, e] = r["n"]
        new[p][e] = [int(v) // r["n"] for v in r["total"]]
    return new, members


def _owners(members: np.ndarray, slots: int) -> np.ndarray:
    """Salts of each entry: none is to hold more than half of an even share of a position's parts."""
    share = np.maximum(1, members.sum() // (2 * slots))
    return np.maximum(1, -(-members // share))


def codebooks_digest(books: list[list[list[int]]]) -> str:
    numbers = ",".join(str(v) for book in books for entry in book for v in entry)
    return hashlib.sha256(numbers.encode()).hexdigest()


def compress(rows: DataFrame, vec_id: str = "vec_id", vector: str = "embedding", label: str = "label",
             parts: int = PARTS, rounds: int = ROUNDS) -> tuple[DataFrame, list[list[list[int]]]]:
    """``(vec_id, label, code, error)`` of every usable vector, and the final codebooks.

    The codebook of a position starts as that part of the 256 vectors with the smallest ids.

    Odd input. Null vectors, empty ones and those with null or non-finite components are left out,
    and so are vectors whose length is not that of most others (the longer one where two lengths are
    equally frequent) or cannot be cut in ``parts`` equal parts. Rows with repeated ids are rows of
    their own; those with a null id come last in the start order, equal ids are ordered by vector.
    Fewer than 256 vectors make that many entries. Other columns are ignored. An empty table gives
    no rows. An error that 64 bits cannot hold is null.
    """
    spark, scratch = rows.sparkSession, Scratch(rows.sparkSession)
    slots = int(spark.conf.get("spark.sql.shuffle.partitions"))
    good = rows.select(F.col(vec_id).cast("long").alias("vec_id"), F.col(label).alias("label"),
                       F.col(vector).cast("array<double>").alias("vector")).where(usable(F.col("vector")))
    base = scratch.table(good.where(F.size("vector") % parts == 0).withColumn(
        "row", F.monotonically_increasing_id()), "vectors")
    lengths = base.groupBy(F.size("vector").alias("size")).agg(
        F.count(F.lit(1)).alias("n"),
        F.max(F.array_max(F.transform("vector", F.abs))).alias("largest"))
    most = lengths.orderBy(F.desc("n"), F.desc("size")).first()
    if most is None:
        return base.select("vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error")), []
    base = base.where(F.size("vector") == most["size"])
    cut = Cut.of(most["size"], most["largest"], parts)
    first = base.select("vec_id", "vector").orderBy(F.col("vec_id").asc_nulls_last(), "vector").limit(
        ENTRIES).collect()
    start = cut.integers(np.array([r["vector"] for r in first], dtype=float))
    books = [[[int(v) for v in row[p * cut.width:(p + 1) * cut.width]] for row in start]
             for p in range(parts)]

    kind = T.StructType([T.StructField("position", T.IntegerType()), T.StructField("entry", T.IntegerType()),
                         T.StructField("row", T.LongType()), T.StructField("part", cut.column)])
    owned = T.StructType([*kind.fields, T.StructField("salt", T.IntegerType())])
    columns = ["position", "entry", "row", "part"]
    placed, path = scratch.save(base.select("row", "vector").mapInArrow(_cut(cut, books), kind), "placed")
    members = np.zeros((parts, ENTRIES), dtype=np.int64)
    for r in placed.groupBy("position", "entry").count().collect():  # one row per entry at most
        members[r["position"], r["entry"]] = r["count"]

    def settled(df: DataFrame) -> DataFrame:
        return df.repartition(slots, "position", "entry", "salt")

    salts = _owners(members, slots)

    def salted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("salt", pa.array(_salts(
                *(batch.column(i).to_numpy() for i in (2, 0, 1)), salts)))

    residents, old = scratch.save(settled(placed.mapInArrow(salted, owned)), "residents")
    scratch.drop(path)
    here = [old]
    for _ in range(rounds - 1):
        books, members = _update(residents, cut, books)
        step = residents.select(*columns).mapInArrow(
            _assign(cut, books, _owners(members, slots)),
            T.StructType([*owned.fields, T.StructField("moved", T.BooleanType())]))
        path = f"{scratch.root}/round-{len(here)}-{_}"
        step.write.partitionBy("moved").parquet(path)
        both = spark.read.schema(step.schema).parquet(path)
        moved, arrived = scratch.save(settled(both.where("moved").drop("moved")), "arrived")
        residents = both.where("not moved").drop("moved").unionByName(moved)
        for gone in here:
            scratch.drop(gone)
        here = [path, arrived]
    books, members = _update(residents, cut, books)
    final = residents.select(*columns).mapInArrow(
        _assign(cut, books, None), "position int, entry int, row long, away long")
    codes = final.groupBy("row").agg(
        F.concat(*[F.max(F.when(F.col("position") == p, F.lpad(F.lower(F.hex("entry")), 2, "0")))
                   for p in range(parts)]).alias("code"),
        F.when(F.count("away") == parts, F.try_sum("away")).alias("error"))
    return base.select("row", "vec_id", "label").join(codes, "row").drop("row"), books


def codes(rows: DataFrame) -> DataFrame:
    """The digest of a compression: one row per usable vector; odd input as in :func:`compress`.

    The errors of a label are summed in partial aggregates and joined back; Spark broadcasts the sums
    only where their written table is small. A label with an error that is null has a null sum, and
    so has one whose sum leaves 64 bits.
    """
    scratch = Scratch(rows.sparkSession)
    made, books = compress(rows)
    made = scratch.table(made, "codes")
    whole = F.count(F.lit(1)) == F.count("error")
    sums = scratch.table(made.groupBy("label").agg(
        F.when(whole, F.try_sum("error")).alias("label_error")), "labels")
    return made.join(sums, made["label"].eqNullSafe(sums["label"])).select(
        "vec_id", "code", "error", "label_error",
        F.lit(codebooks_digest(books)).alias("codebooks_sha256"))


def oracle(rounds: int = ROUNDS) -> str:
    """The same in SQL, every component a row."""
    ctes = [f"""kept as materialized (
  select row_number() over () r, vec_id, label, embedding from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: isfinite(x))) = len(embedding)
), cells as materialized (
  select r, (i // (size // {PARTS}))::int p, (i % (size // {PARTS}))::int c,
         floor({SCALE} * embedding[i + 1]::double)::hugeint x
  from (select r, embedding, len(embedding) size, unnest(range(len(embedding))) i from kept)
), first_rows as (
  select r, row_number() over (order by vec_id nulls last, embedding) - 1 e from kept
  qualify e < {ENTRIES}
), book0 as materialized (
  select p, e, c, x from cells join first_rows using (r))"""]
    for i in range(rounds + 1):
        ctes.append(f"""near{i} as materialized (
  select p, r, min(struct_pack(d := d, e := e)) n from (
    select a.p, a.r, b.e, sum((a.x - b.x) * (a.x - b.x)) d
    from cells a join book{i} b on a.p = b.p and a.c = b.c group by all)
  group by all)""")
        if i < rounds:
            ctes.append(f"""sums{i} as (
  select p, n.e e, c, sum(x)::hugeint s, count(*)::hugeint k
  from near{i} join cells using (p, r) group by all
), book{i + 1} as materialized (
  select p, e, c, case when k is null then x else (s - ((s % k) + k) % k) // k end x
  from book{i} left join sums{i} using (p, e, c))""")
    ctes.append(f"""coded as (
  select r, string_agg(lpad(printf('%x', n.e::bigint), 2, '0'), '' order by p) code,
         sum(n.d)::bigint error from near{rounds} group by r
), book as (
  select sha256(string_agg(x::varchar, ',' order by p, e, c)) codebooks_sha256 from book{rounds})""")
    return "with " + ", ".join(ctes) + """
select vec_id, code, error, (sum(error) over (partition by label))::bigint label_error, codebooks_sha256
from coded join kept using (r) cross join book"""
