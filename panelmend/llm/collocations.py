"""Phrases of two to four words that occur together, counted by broadcast tries.

Texts are lower-cased in A-Z, split into pieces at punctuation and line ends, and pieces into words;
a phrase lies within one piece. Work goes in two halves.

*Candidates, by Apriori.* Level by level, tasks hash the phrases of n words whose first and last n - 1
words can still be frequent, and Spark adds up the counts of every hash. Hashes below the least count
are out; phrases that share a hash only raise its sum, so no frequent phrase is ever lost. The hashes
still in reach the next level as a bitmap of fixed size, which lets some more through but none less.
After the last level the phrases of the remaining hashes are named, once each.

*Counts, by tries.* The candidates are dealt by hash into double-array tries of bounded size, built in
tasks and broadcast a few at a time. A task walks the text from all word starts at once, one byte
deeper at each step, dropping starts whose path ends, and bincounts the accepting states that are
followed by the end of a word. The tasks' counts are summed; these alone decide what is frequent.

Phrases are scored at their weakest cut by ordinary joins and windows; see :func:`collocations`.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from panelmend.llm import tries
from panelmend.llm.common import Scratch
from panelmend.llm.shingles import mixed, text_bytes

LONGEST = 4
LEAST = 30
TOP = 2000
#: Stands for a missing language.
NO_LANG = "und"
#: Bytes of text handled at a time; a longer stretch without punctuation stays whole.
SLICE_BYTES = 1 << 20
#: Hashes that are sorted together before they leave a task.
HASHES = 2_000_000
#: Bits of the bitmap of hashes that are still in: 8 MB at any number of them.
FILTER_BITS = 1 << 26
#: Bytes of the keys of one trie; its arrays take at most 12 times that, 3 to 4 times as a rule.
TRIE_BYTES = 8 << 20
#: Counts of a trie's keys that leave a task as one row.
BLOCK = 4096
#: Tries broadcast together; more of them take more passes over the texts.
TRIES = 4

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_BREAK = np.zeros(256, dtype=bool)
_BREAK[[ord(c) for c in ".,;:!?"] + [10, 11, 12, 13]] = True
_SOLID = ~_BREAK
_SOLID[[32, 9]] = False
_SPACE, _END = 32, 10
_BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)
_VALUES = np.random.default_rng(12).integers(1, 2 ** 63, (2, 256), dtype=np.uint64)


@dataclass
class Words:
    """The words of a stretch of texts, one space or (after a piece) one line end behind each."""

    text: np.ndarray
    start: np.ndarray
    end: np.ndarray
    room: np.ndarray  # words from here to the end of the piece
    doc: np.ndarray  # index of each word's text in its batch

    def prefix(self, which: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Prefix sums of a polynomial hash, and the inverse powers that shift it to a start."""
        size = len(self.text) + 1
        power = np.full(size, _BASES[which], dtype=np.uint64)
        inverse = np.full(size, pow(_BASES[which], -1, 1 << 64), dtype=np.uint64)
        power[0] = inverse[0] = 1
        power, inverse = np.multiply.accumulate(power), np.multiply.accumulate(inverse)
        total = np.zeros(size, dtype=np.uint64)
        np.cumsum(_VALUES[which][self.text] * power[:-1], out=total[1:])
        return total, inverse

    def hashes(self, at: np.ndarray, n: int, prefix, langs: np.ndarray) -> np.ndarray:
        total, inverse = prefix
        start = self.start[at]
        return mixed(((total[self.end[at + n - 1]] - total[start]) * inverse[start])
                     ^ langs[self.doc[at]])


def stretches(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Cuts between texts, or where a long text has punctuation: never inside a piece."""
    at = 0
    while at < len(data):
        stop = at + SLICE_BYTES
        if stop < len(data):
            edge = int(offsets[np.searchsorted(offsets, stop, "right") - 1])
            if edge > at:
                stop = edge
            else:
                inner = np.flatnonzero(_BREAK[data[at:stop]])
                end = int(offsets[np.searchsorted(offsets, at, "right")])
                if len(inner):
                    stop = at + int(inner[-1]) + 1
                else:
                    later = np.flatnonzero(_BREAK[data[stop:end]])
                    stop = stop + int(later[0]) + 1 if len(later) else end
        stop = min(stop, len(data))
        yield at, stop
        at = stop


def words(data: np.ndarray, offsets: np.ndarray, low: int, high: int) -> Words | None:
    part = data[low:high]
    solid = _SOLID[part]
    first, last = solid.copy(), solid.copy()
    first[1:] &= ~solid[:-1]
    last[:-1] &= ~solid[1:]
    inner = offsets[(offsets > low) & (offsets < high)] - low
    first[inner] = solid[inner]  # a word never crosses into the next text
    last[inner - 1] = solid[inner - 1]
    begin, stop = np.flatnonzero(first), np.flatnonzero(last) + 1
    n = len(begin)
    if not n:
        return None
    doc = np.searchsorted(offsets, low + begin, "right") - 1
    breaks = np.cumsum(_BREAK[part], dtype=np.int32)[begin]
    final = np.ones(n, dtype=bool)
    final[:-1] = (breaks[1:] != breaks[:-1]) | (doc[1:] != doc[:-1])
    lengths = stop - begin
    end = np.cumsum(lengths + 1) - 1
    start = end - lengths
    text = np.full(int(end[-1]) + 1, _SPACE, dtype=np.uint8)
    text[end[final]] = _END
    text[np.arange(int(lengths.sum())) + np.repeat(np.arange(n), lengths)] = _LOWER[part[solid]]
    closing = np.flatnonzero(final)
    room = np.repeat(closing, np.diff(np.append(-1, closing))) - np.arange(n) + 1
    return Words(text, start, end, room, doc)


def batches_of_words(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[list[str], np.ndarray, Words]]:
    """Languages, the language of each text, and the words, stretch by stretch."""
    for batch in batches:
        coded = batch.column(0).dictionary_encode()
        data, offsets = text_bytes(batch.column(1))
        for low, high in stretches(data, offsets):
            found = words(data, offsets, low, high)
            if found is not None:
                yield coded.dictionary.to_pylist(), coded.indices.to_numpy(), found


def _lang_hashes(names: list[str], index: np.ndarray) -> np.ndarray:
    seeds = [int.from_bytes(hashlib.sha256(x.encode()).digest()[:8], "little") for x in names]
    return np.array(seeds, dtype=np.uint64)[index]


def _among(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    at = hashes & np.uint64(FILTER_BITS - 1)
    return (bits[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _possible(found: Words, n: int, prefix, langs: np.ndarray, bits: list[np.ndarray]) -> np.ndarray:
    """Starts of phrases of n words whose first and last n - 1 words are still in."""
    at = np.flatnonzero(found.room >= n)
    if n > 1 and len(at):
        at = at[_among(bits[n - 2], found.hashes(at, n - 1, prefix, langs))]
        at = at[_among(bits[n - 2], found.hashes(at + 1, n - 1, prefix, langs))]
    return at


def _sieve(n: int, shared):
    """Counts of the hashes of phrases of n words; at the first level also words by language."""
    def packed(hashes: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(hashes), return_counts=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(values.view(np.int64)), pa.nulls(len(values), pa.string()), pa.array(counts)],
            names=["h", "lang", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [b.value for b in shared]
        held, size = [], 0
        totals: dict[str, int] = {}
        for names, index, found in batches_of_words(batches):
            langs = _lang_hashes(names, index)
            prefix = found.prefix()
            at = _possible(found, n, prefix, langs, bits)
            held.append(found.hashes(at, n, prefix, langs))
            size += len(at)
            if n == 1:
                each = np.bincount(index[found.doc], minlength=len(names))
                for name, count in zip(names, each.tolist()):
                    totals[name] = totals.get(name, 0) + count
            if size >= HASHES:
                yield packed(held)
                held, size = [], 0
        if size:
            yield packed(held)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(len(totals), pa.int64()), pa.array(list(totals), pa.string()),
             pa.array(list(totals.values()), pa.int64())], names=["h", "lang", "n"])
    return run


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the hashes' low ends: 2,048 rows of 4 kB at most, made by Spark's own aggregate."""
    place = F.col("h").bitwiseAND(F.lit(FILTER_BITS - 1)) + 1
    rows = hashes.groupBy(F.bitmap_bucket_number(place).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits")).collect()
    out = np.zeros(FILTER_BITS // 8, dtype=np.uint8)
    for r in rows:
        at = (r["bucket"] - 1) * 4096
        out[at:at + 4096] = np.frombuffer(r["bits"], dtype=np.uint8)
    return out


def _names(longest: int, shared):
    """The phrases whose hashes are still in, once per stretch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = [b.value for b in shared]
        for names, index, found in batches_of_words(batches):
            langs = _lang_hashes(names, index)
            first, second = found.prefix(0), found.prefix(1)
            for n in range(1, longest + 1):
                at = _possible(found, n, first, langs, bits)
                hashes = found.hashes(at, n, first, langs)
                still = _among(bits[n - 1], hashes)
                at, hashes = at[still], hashes[still]
                if not len(at):
                    continue
                values, chosen, back = np.unique(hashes, return_index=True, return_inverse=True)
                other = found.hashes(at, n, second, langs)
                # what shares a hash with another phrase of the stretch is named as well
                chosen = np.concatenate([chosen, np.flatnonzero(other != other[chosen][back])])
                at, hashes = at[chosen], hashes[chosen]
                start, length = found.start[at], found.end[at + n - 1] - found.start[at]
                ends = np.append(0, np.cumsum(length))
                flat = found.text[np.arange(ends[-1]) + np.repeat(start - ends[:-1], length)]
                phrases = pa.Array.from_buffers(
                    pa.large_binary(), len(at),
                    [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(flat)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(hashes.view(np.int64)), phrases.cast(pa.large_string()).cast(pa.string()),
                     pa.array(names, pa.string()).take(pa.array(index[found.doc[at]])),
                     pa.array(np.full(len(at), n, np.int32))], names=["h", "phrase", "lang", "words"])
    return run


def candidates(texts: DataFrame, scratch: Scratch, longest: int, least: int) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase)`` of all phrases that may be frequent, and the words of each language."""
    context = texts.sparkSession.sparkContext
    shared, alive, totals = [], None, None
    for n in range(1, longest + 1):
        sums = texts.mapInArrow(_sieve(n, shared), "h long, lang string, n long").groupBy(
            "h", "lang").agg(F.sum("n").alias("n"))
        kept = scratch.table(sums.where((F.col("n") >= least) | F.col("h").isNull()), f"hashes{n}")
        if n == 1:
            totals = kept.where("h is null").select("lang", "n")
        kept = kept.where("h is not null").select("h", F.lit(n).alias("words"))
        alive = kept if alive is None else alive.unionByName(kept)
        shared.append(context.broadcast(_bitmap(kept)))
    named = texts.mapInArrow(_names(longest, shared), "h long, phrase string, lang string, words int")
    # the bitmaps let some hashes through that are out
    named = named.distinct().join(alive, ["h", "words"], "left_semi")
    return scratch.table(named.select("lang", "phrase").distinct(), "candidates"), totals


def _key(lang: Column, phrase: Column) -> Column:
    """A phrase under its language; no phrase holds a line end."""
    return F.concat(lang.cast("binary"), F.lit("\n").cast("binary"), phrase.cast("binary"))


def _built(part: pa.Table) -> pa.Table:
    keys = part.column("key").combine_chunks().cast(pa.large_binary()).sort()
    offsets = np.frombuffer(keys.buffers()[1], dtype=np.int64)[keys.offset:keys.offset + len(keys) + 1]
    made = tries.build(np.frombuffer(keys.buffers()[2], dtype=np.uint8), offsets)
    return pa.table({"trie": part.column("trie").slice(0, 1), **{
        name: pa.array([getattr(made, name).astype(np.int32).tobytes()], pa.binary())
        for name in ("base", "check", "accept", "ends")}})


def _opened(row: dict[str, bytes]) -> tries.Trie:
    return tries.Trie(*(np.frombuffer(row[k], dtype=np.int32) for k in ("base", "check", "accept", "ends")))


def occurrences(found: Words, root: np.ndarray, trie: tries.Trie) -> np.ndarray:
    """Ranks of the keys at each place where one ends a word; ``root`` is the state before a word."""
    at, state = found.start[root >= 0], root[root >= 0]
    out = []
    while len(at):
        cell = trie.base[state].astype(np.int64) + found.text[at]
        held = trie.check[cell] == state
        at, state = at[held] + 1, cell[held]
        rank = trie.accept[state]
        ended = (rank >= 0) & (found.text[np.minimum(at, len(found.text) - 1)] <= _SPACE)
        out.append(rank[ended])
    return np.concatenate(out) if out else np.zeros(0, dtype=np.int32)


def _scan(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened = [_opened(row) for row in shared.value]
        counts = [np.zeros(len(t.ends), dtype=np.int64) for t in opened]
        for names, index, found in batches_of_words(batches):
            for trie, count in zip(opened, counts):
                roots = np.array([trie.walk(x.encode() + b"\n") for x in names], dtype=np.int64)
                ranks = occurrences(found, roots[index[found.doc]], trie)
                count += np.bincount(ranks, minlength=len(count))
        for row, count in zip(shared.value, counts):
            blocks = [count[at:at + BLOCK] for at in range(0, len(count), BLOCK)]
            some = [i for i, block in enumerate(blocks) if block.any()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(some), row["trie"], np.int32)), pa.array(some, pa.int32()),
                 pa.array([blocks[i].astype(np.int64).tobytes() for i in some], pa.binary())],
                names=["trie", "block", "counts"])
    return run


def _summed(shared, least: int):
    """Adds up the tasks' blocks of counts and spells what is frequent."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            for trie, block, data in zip(*(c.to_pylist() for c in batch.columns)):
                new = np.frombuffer(data, dtype=np.int64)
                sums[trie, block] = sums[trie, block] + new if (trie, block) in sums else new
        opened = {row["trie"]: row for row in shared.value}
        made: dict[int, tries.Trie] = {}
        for (trie, block), f in sums.items():
            at = np.flatnonzero(f >= least)
            if not len(at):
                continue
            if trie not in made:
                made[trie] = _opened(opened[trie])
            keys = [k.rpartition(b"\n") for k in made[trie].spelled(block * BLOCK + at)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k[0].decode() for k in keys], pa.string()),
                 pa.array([k[2].decode() for k in keys], pa.string()), pa.array(f[at])],
                names=["lang", "phrase", "f"])
    return run


def counted(texts: DataFrame, phrases: DataFrame, scratch: Scratch, least: int,
            trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """``(lang, phrase, f)`` of those ``phrases`` that occur at least ``least`` times."""
    spark = texts.sparkSession
    keyed = phrases.select(_key(F.col("lang"), F.col("phrase")).alias("key"))
    size = keyed.agg(F.sum(F.length("key"))).first()[0] or 0
    n = -(-size // trie_bytes)
    made = scratch.table(keyed.withColumn("trie", F.pmod(F.xxhash64("key"), F.lit(max(1, n))).cast("int"))
                         .groupBy("trie").applyInArrow(
        _built, "trie int, base binary, check binary, accept binary, ends binary"), "tries")
    slots, out = int(spark.conf.get("spark.sql.shuffle.partitions")), None
    for at in range(0, n, TRIES):
        # bounded: a few tries of bounded size
        rows = [r.asDict() for r in made.where(F.col("trie").between(at, at + TRIES - 1)).collect()]
        shared = spark.sparkContext.broadcast(rows)
        sums = texts.mapInArrow(_scan(shared), "trie int, block int, counts binary").repartition(
            slots, "trie", "block")
        some = scratch.table(sums.mapInArrow(_summed(shared, least), "lang string, phrase string, f long"),
                             "counts")
        shared.unpersist()
        out = some if out is None else out.unionByName(some)
    return phrases.select("lang", "phrase", F.lit(0).cast("long").alias("f")) if out is None else out


def collocations(documents: DataFrame, text: str = "text", lang: str = "lang", longest: int = LONGEST,
                 least: int = LEAST, top: int | None = TOP, trie_bytes: int = TRIE_BYTES) -> DataFrame:
    """Each language's best phrases: ``lang, rank, phrase, a, l, r, n, score``.

    ``a`` counts the phrase, ``l`` and ``r`` the two parts at the cut with the lowest score
    floor(2,000,000 a / (l + r)) (the first of equal ones), ``n`` the words of the language. A phrase
    is left out when it lies in a longer one at least four fifths as frequent. ``top`` None keeps all.

    Odd input. Null and empty texts have no words; a null language counts as ``und``, an empty one is
    a language of its own; repeated rows count each time; equal scores are ordered by count, then by
    phrase as UTF-8 bytes; other columns are ignored; no rows give no rows. Long texts are cut at
    punctuation; only a stretch without any is held whole.
    """
    scratch = Scratch(documents.sparkSession)
    texts = documents.select(F.coalesce(F.col(lang).cast("string"), F.lit(NO_LANG)).alias("lang"),
                             F.coalesce(F.col(text), F.lit("")).alias("text"))
    phrases, totals = candidates(texts, scratch, longest, least)
    f = scratch.table(counted(texts, phrases, scratch, least, trie_bytes), "frequent")
    wide = f.select("lang", "phrase", F.col("f").alias("a"), F.split("phrase", " ").alias("w")).where(
        F.size("w") >= 2)

    def joined(column: str, begin: Column | int, n: Column) -> Column:
        return F.array_join(F.slice(column, begin, n), " ")

    cuts = wide.select("lang", "phrase", "a", "w", F.explode(F.sequence(
        F.lit(1), F.size("w") - 1)).alias("k")).select(
        "lang", "phrase", "a", "k", joined("w", 1, F.col("k")).alias("left"),
        joined("w", F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    part = lambda p, n: f.select("lang", F.col("phrase").alias(p), F.col("f").alias(n))
    cuts = cuts.join(part("left", "l"), ["lang", "left"]).join(part("right", "r"), ["lang", "right"])
    # decimals: the product may pass 64 bits
    scored = cuts.withColumn("score", F.expr(
        "cast(2000000 * cast(a as decimal(20)) div (cast(l as decimal(20)) + r) as long)"))
    weakest = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut"))
    spans = F.expr("filter(flatten(transform(sequence(2, size(w)), n -> transform(sequence(1, "
                   "size(w) - n + 1), i -> array_join(slice(w, i, n), ' ')))), x -> x <> phrase)")
    inside = wide.where(F.size("w") > 2).select("lang", F.explode(spans).alias("phrase"), "a").groupBy(
        "lang", "phrase").agg(F.max("a").alias("longer"))
    kept = weakest.join(inside, ["lang", "phrase"], "left").where(
        "longer is null or 100 * cast(longer as decimal(20)) < 80 * cast(a as decimal(20))")
    best = Window.partitionBy("lang").orderBy(F.desc("cut.score"), F.desc("a"), "phrase")
    ranked = kept.withColumn("rank", F.row_number().over(best))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select(
        "lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", F.col("cut.l").alias("l"),
        F.col("cut.r").alias("r"), "n", F.col("cut.score").alias("score"))


ORACLE = rf"""
with pieces as materialized (
  select coalesce(lang, '{NO_LANG}') lang, d, p, regexp_extract_all(piece, '[^ \t]+') w from (
    select lang, d, unnest(s) piece, unnest(range(len(s))) p from (
      select lang, row_number() over () d, string_split_regex(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[.,;:!?\n\x0B\f\r]') s from documents))
), totals as (
  select lang, sum(len(w))::bigint n from pieces group by lang
), grams as materialized (
  select lang, phrase, count(*) f, any_value(k) k from (
    select lang, k, array_to_string(w[i:i + k - 1], ' ') phrase from (
      select lang, w, k, unnest(range(1, len(w) - k + 2)) i
      from pieces, (select unnest(range(1, {LONGEST + 1})) k)))
  group by lang, phrase having count(*) >= {LEAST}
), wide as materialized (
  select lang, phrase, f a, string_split(phrase, ' ') w from grams where k > 1
), cuts as (
  select c.lang, c.phrase, c.a, c.k, x.f l, y.f r,
         ((2000000::hugeint * c.a) // (x.f + y.f))::bigint score
  from (select *, unnest(range(1, len(w))) k from wide) c
  join grams x on x.lang = c.lang and x.phrase = array_to_string(c.w[1:c.k], ' ')
  join grams y on y.lang = c.lang and y.phrase = array_to_string(c.w[c.k + 1:], ' ')
), weakest as (
  select lang, phrase, a, min(struct_pack(score := score, k := k, l := l, r := r)) cut
  from cuts group by all
), inside as (
  select lang, array_to_string(w[i:i + m - 1], ' ') phrase, max(a) longer from (
    select *, unnest(range(1, len(w) - m + 2)) i from (
      select *, unnest(range(2, len(w))) m from wide where len(w) > 2))
  group by all
), ranked as (
  select w.*, row_number() over (partition by lang order by cut.score desc, a desc, phrase) rank
  from weakest w left join inside i using (lang, phrase)
  where longer is null or 100::hugeint * longer < 80::hugeint * a
)
select lang, rank, phrase, a, cut.l l, cut.r r, n, cut.score score
from ranked join totals using (lang) where rank <= {TOP}"""
