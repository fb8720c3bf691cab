"""N-gram Jaccard join: a blocked sparse product of the document by n-gram incidence matrix.

Which entries of the product are wanted comes from a few columns: all columns are put in one order
for all documents, rare ones first (by a bounded table of counts over the whole corpus, then by
hash), and two sets can only be similar enough if they share a column among the first few of each
(how many follows from the set's size). Pairs that share one are discarded by bounds from their
sizes, the places of what they share and the sizes of their parts in each of 128 blocks of columns.

The wanted entries are then multiplied block by block: rows are cut into blocks of columns of bounded
length, a pair meets its two parts of a block, every shared column adds one to the overlap, and the
blocks' overlaps of a pair are added up and compared with what its sizes ask for.

No list of columns is expanded into all its pairs at first: round one pairs every document of a
list with the list's first one. Further rounds multiply only across the components of the links
found so far: first each document of a list with the nearest one of another component, as the
blocks see it; then all that is still apart. Lists of more than ``LIST`` documents are cut into hashed
parts, each two of which meet in a task of their own.
Documents with equal sets are one node throughout.

Defined cases: null, empty and blank texts have an empty set and link with nothing; fewer words than
a shingle form one shingle; repeated rows are linked like other copies; rows without ``doc_id`` get
their set's size and no component; rows of one ``doc_id`` with different texts are told apart; an empty
table gives an empty result; other columns are ignored. Sets are compared by 64-bit hashes of shingles.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelmend.llm.common import Scratch, connected_components, maybe_among
from panelmend.llm.shingles import digests, shingle_sets, slices

#: Counters of the table by which columns are ordered, and the pieces it is added up in.
COUNTERS = 1 << 20
PIECES = 64
#: Blocks of columns by which overlaps are bounded, and the largest set that is bounded so.
BLOCKS = 128
BLOCKED_SIZE = 65_535
#: Columns in a part of a row, on average, and documents of a list in a task.
PART = 512
LIST = 1024


def _blocks(sets: np.ndarray, at: np.ndarray) -> np.ndarray:
    """How many columns of every set lie in each block."""
    size = np.diff(at)
    block = np.repeat(np.arange(len(size)) * BLOCKS, size) + (sets >> np.uint64(57)).astype(np.int64)
    counts = np.bincount(block, minlength=len(size) * BLOCKS).reshape(len(size), BLOCKS)
    return np.minimum(counts, BLOCKED_SIZE).astype("<u2")


def _needed(size_a, size_b, percent: int):
    """The least overlap of two sets that link."""
    return -(-percent * (size_a + size_b) // (100 + percent))


def _room(size_a, blocks_a, size_b, blocks_b, percent: int) -> np.ndarray:
    """By how much the overlap that the blocks' sizes allow exceeds the one that is needed."""
    most = np.minimum(blocks_a, blocks_b).sum(axis=-1, dtype=np.int64)
    most = np.where((size_a > BLOCKED_SIZE) | (size_b > BLOCKED_SIZE),
                    np.minimum(size_a, size_b), most)
    return most - _needed(size_a, size_b, percent)


def _matrix(blocks: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(blocks), dtype="<u2").reshape(-1, BLOCKS)


def _least_overlap(n: np.ndarray, percent: int) -> np.ndarray:
    """What a set of size n must share at least with any set it links with."""
    return (percent * n + 99) // 100


def _row_keys(text: Column) -> list[Column]:
    """What tells rows of one doc_id apart."""
    return [F.xxhash64(text).alias("key_1"), F.xxhash64(F.lit("second"), text).alias("key_2")]


def _sets(docs: DataFrame, n: int) -> DataFrame:
    """Per document ``doc_id``, its row's keys, ``n_shingles, node``, its blocks; per task pieces of counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNTERS, dtype=np.uint32)
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(3)):
                sets, at = shingle_sets(data, offsets, n)
                np.add.at(counts, sets & np.uint64(COUNTERS - 1), np.uint32(1))
                rows = hi - lo
                yield pa.RecordBatch.from_arrays([
                    *[x.slice(lo, rows) for x in batch.columns[:3]], pa.array(np.diff(at)),
                    pa.array(digests(sets, at)[0]), pa.nulls(rows, pa.int32()),
                    pa.array([x.tobytes() for x in _blocks(sets, at)], pa.binary())], names=names)
        pieces = [zlib.compress(x.tobytes(), 1) for x in counts.reshape(PIECES, -1)]
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(PIECES, pa.int64())] * 5 + [pa.array(range(PIECES), pa.int32()),
                                                  pa.array(pieces, pa.binary())], names=names)

    names = ["doc_id", "key_1", "key_2", "n_shingles", "node", "piece", "counts"]
    return docs.select(F.col("doc_id").cast("long"), *_row_keys(F.col("text")), "text").mapInArrow(
        run, "doc_id long, key_1 long, key_2 long, n_shingles long, node long, piece int, counts binary")


def _summed(pieces: DataFrame) -> np.ndarray:
    """The table of counts; of fixed size, whatever the corpus."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for piece, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                new = np.frombuffer(zlib.decompress(data), dtype=np.uint32).astype(np.uint64)
                sums[piece] = sums[piece] + new if piece in sums else new
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.int32()), pa.array([x.tobytes() for x in sums.values()],
                                                        pa.binary())], names=["piece", "counts"])

    out = np.zeros((PIECES, COUNTERS // PIECES), dtype=np.uint64)
    for row in pieces.repartition(PIECES, "piece").mapInArrow(run, "piece int, counts binary").collect():
        out[row["piece"]] = np.frombuffer(row["counts"], dtype=np.uint64)
    return np.minimum(out.reshape(-1), 2 ** 32 - 1).astype(np.uint32)


def _leading(docs: DataFrame, counts, n: int, percent: int) -> DataFrame:
    """The leading columns of every set: ``column, node, size, place``, a set once per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, done = counts.value, set()
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(0)):
                sets, at = shingle_sets(data, offsets, n)
                node, _ = digests(sets, at)
                size = np.diff(at)
                rank = np.lexsort((sets, table[sets & np.uint64(COUNTERS - 1)],
                                   np.repeat(np.arange(hi - lo), size)))
                sets = sets[rank]
                keep = np.where(size > 0, size - _least_overlap(size, percent) + 1, 0)
                for i, x in enumerate(node.tolist()):
                    if x in done:
                        keep[i] = 0
                    done.add(x)
                begin = np.cumsum(keep) - keep
                place = np.arange(int(keep.sum())) - np.repeat(begin, keep)
                yield pa.RecordBatch.from_arrays([
                    pa.array(sets[np.repeat(at[:-1], keep) + place].view(np.int64)),
                    pa.array(np.repeat(node, keep)), pa.array(np.repeat(size, keep).astype(np.int32)),
                    pa.array(place.astype(np.int32))], names=["column", "node", "size", "place"])

    return docs.select("text").mapInArrow(run, "column long, node long, size int, place int")


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
    """Sorted rows in pieces that never cut a column's list."""
    rest: list[pa.RecordBatch] = []
    for batch in batches:
        column = batch.column(0).to_numpy()
        if not len(column):
            continue
        last = int(np.searchsorted(column, column[-1]))
        if last:
            whole = pa.Table.from_batches([*rest, batch.slice(0, last)])
            yield {c: whole[c].to_numpy() for c in whole.column_names}
            rest = [batch.slice(last)]
        elif rest and rest[0].column(0)[0].as_py() != column[0]:
            whole = pa.Table.from_batches(rest)
            yield {c: whole[c].to_numpy() for c in whole.column_names}
            rest = [batch]
        else:
            rest.append(batch)
    if rest:
        whole = pa.Table.from_batches(rest)
        yield {c: whole[c].to_numpy() for c in whole.column_names}


def _possible(size_a, place_a, size_b, place_b, percent: int) -> np.ndarray:
    """Whether two sets sharing a column at these places may still be similar enough."""
    least, most = np.minimum(size_a, size_b), np.maximum(size_a, size_b)
    needed = _needed(size_a, size_b, percent)
    # the first column they share has all others behind it
    return ((100 * least >= percent * most) & (place_a <= size_a - needed)
            & (place_b <= size_b - needed))


LISTS = "column long, node long, size int, place int, first long"


def _shared(leading: DataFrame, percent: int) -> DataFrame:
    """The lists of more than one node; ``first`` is the list's first node that may link.

    Lists stream through: a task holds a batch and the head of the list that is open.
    """
    names = ["column", "node", "size", "place"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head, told, last = None, False, 0
        for batch in batches:
            rows = np.column_stack([x.to_numpy().astype(np.int64) for x in batch.columns])
            if head is not None:
                rows = rows[(rows[:, 0] != head[0]) | (rows[:, 1] != last)]
                rows = np.vstack([head[None], rows])
            if not len(rows):
                continue
            new = np.ones(len(rows), dtype=bool)
            new[1:] = (rows[1:, :2] != rows[:-1, :2]).any(axis=1)
            rows = rows[new]
            column, node, size, place = rows.T
            start = np.flatnonzero(np.append(True, column[1:] != column[:-1]))
            length = np.diff(np.append(start, len(rows)))
            first = np.repeat(start, length)
            out = np.repeat(length > 1, length)
            may = _possible(size[first], place[first], size, place, percent)
            may &= first != np.arange(len(rows))
            opened = told and len(start) == 1
            if told:
                out[0] = False
            yield pa.RecordBatch.from_arrays([
                pa.array(column[out]), pa.array(node[out]), pa.array(size[out].astype(np.int32)),
                pa.array(place[out].astype(np.int32)), pa.array(node[first][out], mask=~may[out])],
                names=[*names, "first"])
            head, last = rows[start[-1]].copy(), int(node[-1])
            told = opened or length[-1] > 1

    return (leading.select(*names).repartition("column").sortWithinPartitions("column", "node")
            .mapInArrow(run, LISTS))


def _cells(lists: DataFrame) -> DataFrame:
    """Lists in parts: ``cell`` in place of the column, ``part`` of a row where a cell has two, else -1."""
    own = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    other = F.explode(F.sequence(F.lit(0), F.col("parts") - 1))
    cut = lists.withColumn("own", own).withColumn("other", other)
    return cut.select(
        F.when(F.col("parts") == 1, F.col("column")).otherwise(F.xxhash64(
            "column", F.least("own", "other"), F.greatest("own", "other"))).alias("cell"),
        "node", "size", "place", "component", "counts",
        F.when(F.col("own") == F.col("other"), -1).otherwise(F.col("own")).alias("part"))


def _across(lists: DataFrame, percent: int, nearest: bool) -> DataFrame:
    """Pairs ``a, b, size_a, size_b`` of nodes in different components that their lists allow to link.

    ``lists`` has ``column, parts, node, size, place, component, counts``. With ``nearest`` every node of a
    cell is paired only with the one whose blocks leave most room above the overlap that is needed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches):
            start = np.flatnonzero(np.append(True, rows["cell"][1:] != rows["cell"][:-1]))
            out: list[list[np.ndarray]] = []
            ends = np.append(start[1:], len(rows["cell"]))
            low = np.minimum.reduceat(rows["component"], start)
            high = np.maximum.reduceat(rows["component"], start)
            for lo, hi in zip(start[low != high].tolist(), ends[low != high].tolist()):
                size, place = rows["size"][lo:hi].astype(np.int64), rows["place"][lo:hi].astype(np.int64)
                node, component, part = (rows[c][lo:hi] for c in ("node", "component", "part"))
                blocks = _matrix(rows["counts"][lo:hi].tolist())
                every = np.arange(hi - lo)
                for i in range(hi - lo if nearest else hi - lo - 1):
                    j = every if nearest else every[i + 1:]
                    j = j[(component[j] != component[i]) & ((part[j] != part[i]) | (part[i] < 0))
                          & _possible(size[i], place[i], size[j], place[j], percent)]
                    room = _room(size[i], blocks[i], size[j], blocks[j], percent)
                    if nearest and len(j):
                        best = int(room.argmax())
                        j, room = j[best:best + 1], room[best:best + 1]
                    j = j[room >= 0]
                    if len(j):
                        a = np.full(len(j), node[i])
                        swap = a > node[j]
                        out.append([np.where(swap, node[j], a), np.where(swap, a, node[j]),
                                    np.where(swap, size[j], size[i]), np.where(swap, size[i], size[j])])
                    if len(out) >= 2000:
                        yield batch_of(out)
                        out = []
            if out:
                yield batch_of(out)

    def batch_of(out):
        return pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(c)) for c in zip(*out)], names=["a", "b", "size_a", "size_b"])

    return (_cells(lists).repartition("cell").sortWithinPartitions("cell", "node")
            .mapInArrow(run, "a long, b long, size_a long, size_b long").distinct())


def _bounded(pairs: DataFrame, nodes: DataFrame, percent: int) -> DataFrame:
    """Of the pairs ``a, b`` those whose blocks allow for the overlap that is needed, with sizes."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size_a, size_b = batch.column(2).to_numpy(), batch.column(4).to_numpy()
            keep = pa.array(_room(size_a, _matrix(batch.column(3).to_pylist()), size_b,
                                  _matrix(batch.column(5).to_pylist()), percent) >= 0)
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(keep) for c in (0, 1, 2, 4)],
                                             names=["a", "b", "size_a", "size_b"])

    def side(name):
        return nodes.select(F.col("node").alias(name), F.col("n_shingles").alias(f"size_{name}"),
                            F.col("counts").alias(f"counts_{name}"))

    return (pairs.join(side("a"), "a").join(side("b"), "b")
            .select("a", "b", "size_a", "counts_a", "size_b", "counts_b")
            .mapInArrow(run, "a long, b long, size_a long, size_b long"))


def _shift(size: np.ndarray, length: int) -> np.ndarray:
    """Rows of this size are cut into ``2 ** shift`` blocks of columns."""
    return np.frexp((np.maximum(size, 1) - 1) // length)[1]  # bits of the quotient


def _parts(docs: DataFrame, nodes: DataFrame, n: int, percent: int) -> DataFrame:
    """The rows of the matrix for these nodes in blocks: ``node, shift, part, columns``.

    A pair is cut as the larger of the two asks for, so a row is cut for every size it may link with.
    """
    among, length = maybe_among(nodes.select("doc_id")), PART

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, offsets in slices(batch.column(0)):
                sets, at = shingle_sets(data, offsets, n)
                node, _ = digests(sets, at)
                size = np.diff(at)
                low, high = _shift(size, length), _shift(size * 100 // percent, length)
                for shift in range(int(low.min()), int(high.max()) + 1):
                    cut = (low <= shift) & (shift <= high)
                    of = np.repeat(cut, size)
                    columns, owner = sets[of], np.repeat(node, np.where(cut, size, 0))
                    # columns are sorted within a row, so those of a block lie side by side
                    part = (columns >> np.uint64(64 - shift) if shift
                            else np.zeros(len(columns), np.uint64)).astype(np.int32)
                    row = np.repeat(np.arange(hi - lo), np.where(cut, size, 0))
                    start = np.flatnonzero(np.append(
                        True, (part[1:] != part[:-1]) | (row[1:] != row[:-1]))) if len(columns) else []
                    start = np.asarray(start, dtype=np.int64)
                    ends = pa.array(np.append(start, len(columns)).astype(np.int32))
                    yield pa.RecordBatch.from_arrays([
                        pa.array(owner[start]), pa.array(np.full(len(start), shift, np.int32)),
                        pa.array(part[start]),
                        pa.ListArray.from_arrays(ends, pa.array(columns.view(np.int64)))],
                        names=["node", "shift", "part", "columns"])

    rows = docs.where(among(F.col("doc_id"))).select("text").mapInArrow(
        run, "node long, shift int, part int, columns array<long>")
    return (rows.join(nodes.select("node").distinct(), "node", "left_semi")
            .dropDuplicates(["node", "shift", "part"]))


def _product(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, n: int, percent: int,
             scratch: Scratch) -> DataFrame:
    """The pairs ``a, b, size_a, size_b`` whose overlap, added up over blocks of columns, is large enough."""
    ends = pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()
    ends = scratch.table(ends.join(nodes.select("node", "doc_id"), "node"), "ends")
    parts = scratch.table(_parts(docs, ends, n, percent), "parts")
    # as _shift
    times = F.floor((F.greatest("size_a", "size_b") - 1) / PART)
    shift = F.when(times > 0, F.length(F.bin(times))).otherwise(0)
    blocks = pairs.withColumn("shift", shift).withColumn(
        "part", F.explode(F.expr("sequence(0, shiftleft(1, shift) - 1)")))

    def side(name):
        return parts.select(F.col("node").alias(name), "shift", "part",
                            F.col("columns").alias(f"columns_{name}"))

    overlap = F.sum(F.size(F.array_intersect("columns_a", "columns_b")))
    return (blocks.join(side("a"), ["a", "shift", "part"]).join(side("b"), ["b", "shift", "part"])
            .groupBy("a", "b", "size_a", "size_b").agg(overlap.alias("overlap"))
            .where(100 * F.col("overlap")
                   >= percent * (F.col("size_a") + F.col("size_b") - F.col("overlap")))
            .select("a", "b"))


def _classes(docs: DataFrame, n: int, percent: int) -> DataFrame:
    """Per row ``doc_id``, its keys, ``n_shingles, node``, and ``class``: a node, null for empty sets."""
    spark, scratch = docs.sparkSession, Scratch(docs.sparkSession)
    out = scratch.table(_sets(docs, n), "sets")
    counts = spark.sparkContext.broadcast(_summed(
        out.where("piece is not null").select("piece", "counts")))
    rows = out.where("piece is null")
    # equal sets have equal counts, so any row's will do
    nodes = rows.where("n_shingles > 0 and doc_id is not null").groupBy("node", "n_shingles").agg(
        F.min("doc_id").alias("doc_id"), F.first("counts").alias("counts"))
    rows = rows.drop("piece", "counts")
    lists = scratch.table(_shared(_leading(docs, counts, n, percent), percent), "lists")

    pairs = lists.where("first is not null").select(
        F.least("node", "first").alias("a"), F.greatest("node", "first").alias("b")).distinct()
    pairs = scratch.table(_bounded(pairs, nodes, percent), "pairs")
    links = scratch.table(_product(pairs, nodes, docs, n, percent, scratch), "links")
    groups = scratch.table(connected_components(links, scratch), "groups")

    # every round has its price in small jobs, so nearest partners are tried once
    tried = pairs.select("a", "b")
    for nearest in (True, False):
        named = lists.join(groups.withColumnRenamed("id", "node"), "node", "left").select(
            "column", "node", "size", "place",
            F.coalesce("component_id", "node").alias("component"))
        mixed = named.groupBy("column").agg(
            F.min("component").alias("low"), F.max("component").alias("high"),
            F.ceil(F.count(F.lit(1)) / LIST).cast("int").alias("parts")
        ).where("low <> high").select("column", "parts")
        named = named.join(mixed, "column").join(nodes.select("node", "counts"), "node")
        more = scratch.table(_across(named, percent, nearest).join(tried, ["a", "b"], "left_anti"),
                             "more")
        if not more.isEmpty():
            found = _product(more, nodes, docs, n, percent, scratch)
            tried = tried.union(more.select("a", "b"))
            known = groups.select(F.col("id").alias("a"), F.col("component_id").alias("b"))
            groups = scratch.table(connected_components(known.union(found), scratch), "groups")

    of_node = groups.select(F.col("id").alias("node"), F.col("component_id").alias("linked"))
    return rows.join(of_node, "node", "left").select(
        "doc_id", "key_1", "key_2", "n_shingles", "node",
        F.when(F.col("n_shingles") > 0, F.coalesce("linked", "node")).alias("class"))


def similar(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """Per document ``doc_id, n_shingles, component_id``: classes of the similarity join.

    Links: ``100 * |A & B| >= percent * |A | B|`` over distinct ``n``-word shingles; the component
    is the smallest ``doc_id`` reachable by links.
    """
    rows = Scratch(docs.sparkSession).table(_classes(docs, n, percent), "classes")
    least = rows.where("class is not null").groupBy("class").agg(F.min("doc_id").alias("least"))
    return rows.join(least, "class", "left").select(
        "doc_id", "n_shingles",
        F.when(F.col("doc_id").isNotNull(), F.coalesce("least", "doc_id")).alias("component_id"))


def one_of_each(docs: DataFrame, n: int = 5, percent: int = 80) -> DataFrame:
    """The first row of every class, by ``doc_id``, with all its columns.

    Rows are told apart by id and text, so rows of one id stand or fall each for itself; equal ones
    count once. Rows without id stay, and so do empty texts. Only documents that may have to go are
    shuffled with their texts.
    """
    rows = Scratch(docs.sparkSession).table(
        _classes(docs, n, percent).where("doc_id is not null"), "classes")
    row = F.struct("doc_id", "key_1", "key_2")
    first = rows.where("class is not null").groupBy("class").agg(F.min(row).alias("first"))
    gone = rows.join(first, "class").where(row != F.col("first")).select("doc_id", "key_1", "key_2")
    gone = Scratch(docs.sparkSession).table(gone.distinct(), "gone")
    repeated = rows.groupBy("doc_id").count().where("count > 1").select("doc_id")
    among = maybe_among(gone.select("doc_id").union(repeated))
    marked = docs.withColumn("maybe_gone__", among(F.col("doc_id")))
    doubtful = marked.where("maybe_gone__").drop("maybe_gone__")
    gone = gone.select(*[F.col(c).alias(f"gone_{c}__") for c in gone.columns])
    key_1, key_2 = _row_keys(F.col("text"))
    settled = (doubtful.join(gone, (F.col("doc_id").cast("long") == F.col("gone_doc_id__"))
                             & (key_1 == F.col("gone_key_1__")) & (key_2 == F.col("gone_key_2__")),
                             "left_anti")
               .dropDuplicates(["doc_id", "text"]))
    return marked.where("not maybe_gone__").drop("maybe_gone__").unionByName(settled)
