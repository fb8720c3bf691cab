"""Vector codes, collocations and web archives against brute force, with odd input."""

import gzip
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelmend.llm import collocations as col
from panelmend.llm import lloyd, tries, warc

VECTORS = "vec_id long, embedding array<double>, label string, code int, row long"


# -- vector codes -----------------------------------------------------------------------------


def lloyd_by_hand(rows, parts=4, rounds=4):
    """Lists and Python integers only."""
    rows = [r for r in rows if r[1] and all(x is not None and math.isfinite(x) for x in r[1])]
    rows = [r for r in rows if len(r[1]) % parts == 0]
    if not rows:
        return [], []
    sizes = Counter(len(r[1]) for r in rows)
    size = max(sizes, key=lambda s: (sizes[s], s))
    rows = [r for r in rows if len(r[1]) == size]
    rows.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    w = size // parts
    cut = [[[int(x) * 1024 if abs(x) > 1e300 else math.floor(1024 * x) for x in r[1]][p * w:(p + 1) * w]
            for p in range(parts)] for r in rows]
    books = [[c[p] for c in cut[:256]] for p in range(parts)]

    def near(part, book):
        return min((sum((a - b) ** 2 for a, b in zip(part, e)), i) for i, e in enumerate(book))

    for _ in range(rounds):
        for p in range(parts):
            members = {}
            for c in cut:
                members.setdefault(near(c[p], books[p])[1], []).append(c[p])
            for e, some in members.items():
                books[p][e] = [sum(x) // len(some) for x in zip(*some)]
    out = []
    for r, c in zip(rows, cut):
        found = [near(c[p], books[p]) for p in range(parts)]
        out.append((r[0], "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), r[2]))
    return out, books


def odd(width):
    return [(900, None, "a"), (901, [], "a"), (902, [None] + [1.0] * (width - 1), "a"),
            (903, [float("nan")] * width, "b"), (904, [float("inf")] * width, "b"),
            (905, [1.0] * (width + 1), "b"), (906, [1.0] * (2 * width), None)]


def check_codes(spark, rows):
    got = lloyd.codes(spark.createDataFrame([(*r, 1, 2) for r in rows], VECTORS).repartition(3)).collect()
    want, books = lloyd_by_hand(rows)
    fits = lambda v: v if v is not None and v < 1 << 63 else None
    sums = {}
    for _, _, error, label in want:
        old = sums.get(label, 0)
        sums[label] = None if old is None or fits(error) is None else fits(old + error)
    assert Counter((r.vec_id, r.code, r.error, r.label_error) for r in got) == Counter(
        (i, code, fits(error), sums[label]) for i, code, error, label in want)
    numbers = ",".join(str(v) for b in books for e in b for v in e)
    assert {r.codebooks_sha256 for r in got} <= {hashlib.sha256(numbers.encode()).hexdigest()}


def test_codes_equal_lloyd_by_hand(spark):
    rng = np.random.default_rng(5)
    centres = rng.standard_normal((300, 8))
    x = centres[rng.integers(0, 300, 700)] + 0.05 * rng.standard_normal((700, 8))
    rows = [(int(i) * 3 % 701, v.tolist(), "abc"[i % 3] if i % 10 else None) for i, v in enumerate(x)]
    # one vector holds a third of all rows; repeated ids, a null id, negative and tied values
    rows += [(1000 + i, x[0].tolist(), "hot") for i in range(350)]
    rows += [(5, x[1].tolist(), "a"), (5, x[2].tolist(), "a"), (None, x[3].tolist(), "a")]
    rows += [(-7, [0.5, -0.5] * 4, "t"), (-8, [-0.5, 0.5] * 4, "t")] + odd(8)
    check_codes(spark, rows)


@pytest.mark.parametrize("scale", [1e5, 1e200, 1.5e305])
def test_codes_are_exact_at_any_size(spark, scale):
    rng = np.random.default_rng(6)
    rows = [(i, (scale * rng.standard_normal(4)).tolist(), "ab"[i % 2]) for i in range(40)]
    check_codes(spark, rows)


def test_codes_of_few_or_no_vectors(spark):
    check_codes(spark, odd(4)[:6])
    check_codes(spark, [])
    check_codes(spark, [(1, [1.0, 2.0, 3.0, 4.0], None)])


def test_arithmetic_is_chosen_by_its_bound():
    assert lloyd.Cut.of(64, 1.0).kind == "float64"
    assert lloyd.Cut.of(64, 1e5).kind == "int64"
    assert lloyd.Cut.of(64, 1e8).kind == "object"


def test_hot_entries_get_more_owners():
    members = np.zeros((4, 256), dtype=np.int64)
    members[0, 7], members[1:, :] = 100_000, 100
    salts = lloyd._owners(members, 10)
    assert salts[0, 7] >= 10 and salts[1:].max() == 1


# -- phrases ----------------------------------------------------------------------------------


def phrases_by_hand(docs, least, top):
    grams, totals = {}, Counter()
    for _, text, lang in docs:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for n in range(1, 5):
                for i in range(len(w) - n + 1):
                    key = lang, tuple(w[i:i + n])
                    grams[key] = grams.get(key, 0) + 1
    f = {k: n for k, n in grams.items() if n >= least}
    found = {}
    for (lang, w), a in f.items():
        if len(w) == 1:
            continue
        cuts = [(2_000_000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        found.setdefault(lang, []).append((-score, -a, " ".join(w).encode(), f[lang, w[:k]], f[lang, w[k:]], w))
    out = []
    for lang, some in found.items():
        inside = {}
        for (other, w), a in f.items():
            if other == lang and len(w) > 2:
                for n in range(2, len(w)):
                    for i in range(len(w) - n + 1):
                        inside[w[i:i + n]] = max(a, inside.get(w[i:i + n], 0))
        left = sorted(x for x in some if 100 * inside.get(x[5], 0) < 80 * -x[1])
        out += [(lang, i + 1, x[2].decode(), -x[1], x[3], x[4], totals[lang], -x[0])
                for i, x in enumerate(left[:top])]
    return sorted(out)


def prose(n, seed, size=60):
    rng = random.Random(seed)
    names = ["New", "York", "of", "the", "é", "日本", "Ärger", "x" * 300, "a", "United", "Nations", "'s", "-"]
    names += [f"w{i}" for i in range(size)]
    weights = [1 / (i + 1) for i in range(len(names))]
    ends = [" ", " ", " ", "  ", "\t", " \t ", ", ", ".\n", "! ", ";", "\x0b", "\xa0"]
    out = []
    for i in range(n):
        text = ""
        for _ in range(rng.randint(0, 60)):
            word = "New York City" if rng.random() < 0.05 else rng.choices(names, weights)[0]
            text += word + rng.choice(ends)
        out.append((i, text, rng.choice(["en", "en", "en", "de", None, "", "a\nb"])))
    return out


DOCS = "doc_id long, text string, lang string, n string, rank int, phrase string"


@pytest.mark.parametrize("trie_bytes", [col.TRIE_BYTES, 400])
def test_collocations_equal_counting_by_hand(spark, monkeypatch, trie_bytes):
    docs = prose(400, 1) + [(1, None, "en"), (2, "", None), (2, " \t.,", "xx")] + prose(20, 2) * 2
    docs += [(9, "big apple pie recipe " * 40, "hot")] * 30
    rows = [(*d, "n", 1, "p") for d in docs]
    got = col.collocations(spark.createDataFrame(rows, DOCS).repartition(5), least=10, top=50,
                           trie_bytes=trie_bytes).collect()
    assert sorted(tuple(r) for r in got) == phrases_by_hand(docs, 10, 50)
    assert len(got) > 60


def test_collocations_of_long_texts_are_cut_at_punctuation(spark, monkeypatch):
    monkeypatch.setattr(col, "SLICE_BYTES", 64)
    data, offsets = col.text_bytes(__import__("pyarrow").array(
        ["a b, c d. " * 50, "", "no punctuation here " * 20, None, "x, y", "z." * 100]))
    cuts = list(col.stretches(data, offsets))
    assert cuts[0][0] == 0 and cuts[-1][1] == len(data)
    assert all(a[1] == b[0] for a, b in zip(cuts, cuts[1:]))
    edges = set(offsets.tolist())
    assert all(hi in edges or chr(data[hi - 1]) in ".," for _, hi in cuts)
    whole, parts = Counter(), Counter()
    for cut, counts in (([(0, len(data))], whole), (cuts, parts)):
        for lo, hi in cut:
            found = col.words(data, offsets, lo, hi)
            if found is not None:
                for n in range(1, 5):
                    for i in np.flatnonzero(found.room >= n):
                        counts[bytes(found.text[found.start[i]:found.end[i + n - 1]])] += 1
    assert whole == parts


def test_collocations_of_nothing(spark):
    empty = spark.createDataFrame([], DOCS)
    assert col.collocations(empty).collect() == []
    assert col.collocations(spark.createDataFrame([(1, None, None, "", 1, "")], DOCS)).collect() == []


def test_candidates_hold_all_frequent_phrases_and_little_else(spark):
    docs = prose(300, 3, size=400)
    texts = spark.createDataFrame([(d[2] or "und", d[1] or "") for d in docs], "lang string, text string")
    from panelmend.llm.common import Scratch

    found, _ = col.candidates(texts, Scratch(spark), 4, 10)
    grams = Counter()
    for _, text, lang in docs:
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", "".join(c.lower() if c.isascii() else c for c in text)):
            w = re.findall(r"[^\x20\x09]+", piece)
            grams.update((lang or "und", " ".join(w[i:i + n])) for n in range(1, 5) for i in range(len(w) - n + 1))
    assert {(r.lang, r.phrase) for r in found.collect()} == {k for k, n in grams.items() if n >= 10}


def test_double_array_tries():
    rng = random.Random(4)
    for n, letters in ((1, b"a"), (3000, b"abc"), (3000, bytes(range(256)))):
        keys = sorted({bytes(rng.choices(letters, k=rng.randint(1, 12))) for _ in range(n)})
        data = np.frombuffer(b"".join(keys), dtype=np.uint8)
        trie = tries.build(data, np.append(0, np.cumsum([len(k) for k in keys])))
        assert [int(trie.accept[trie.walk(k)]) for k in keys] == list(range(len(keys)))
        assert trie.spelled(np.arange(len(keys))) == keys
        for _ in range(500):
            k = bytes(rng.choices(letters, k=rng.randint(1, 6)))
            state = trie.walk(k)
            assert (state >= 0 and trie.accept[state] >= 0) == (k in set(keys))


# -- archives ---------------------------------------------------------------------------------


PAGES = "page_id long, url string, html string, record_type string, same string, run long"


def pages_rows():
    long = "x" * 1500
    rows = [(i, f"http://www.site{i % 7}.example.com:80/p{i % 3}?q={i}#f", f"page {i} " * (i * 4)) for i in range(80)]
    rows += [(100 + i, "https://hot.example.org/", long) for i in range(60)]
    rows += [(200, "http://a.b/\r\nx%41", "\r\n\r\n" + long + "\r\n\r\n"), (201, "http://a.b/", long + "\r\n"),
             (202, "", "é" * 500), (203, None, "é" * 500), (204, "http://a.b/", "é" * 499 + "x"),
             (205, "http://user@A.B:443/ü", "WARC/1.1\r\n\r\nContent-Length: 5\r\n\r\n" * 60),
             (206, "x", None), (207, "x", ""), (208, "y", "short"), (209, "y", "short"),
             (None, "n", long), (None, "n", "z" * 2000), (None, "n", "z" * 2000), (210, "big", "日本語" * 200_000),
             (159, "https://hot.example.org/again", long), (211, "\x01\x7f", "\n\r" * 700)]
    return rows


def archives_by_hand(rows):
    last = {}
    for i, _, html in rows:
        if i is not None:
            last[html] = max(i, last.get(html, i))
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = len(data) >= 1000 and last.get(html) != i
        out.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response",
                    last.get(html) if revisit else None))
    return Counter(out)


@pytest.mark.parametrize("hot", [warc.HOT_SHARE, 1])
def test_archives_give_back_every_page(spark, tmp_path, monkeypatch, hot):
    monkeypatch.setattr(warc, "HOT_SHARE", hot)
    rows = pages_rows()
    df = spark.createDataFrame([(*r, "t", "s", 1) for r in rows], PAGES).repartition(5)
    path = str(tmp_path / "archives")
    got = warc.archived(df, path).collect()
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got
                   ) == archives_by_hand(rows)
    assert Counter((r.page_id, r.url) for r in got) == Counter((r[0], r[1]) for r in rows)
    # the files themselves, read without the library
    seen = 0
    for file in (tmp_path / "archives").glob("part-*"):
        data = gzip.decompress(file.read_bytes())
        while data:
            head, _, data = data.partition(b"\r\n\r\n")
            assert head.startswith(b"WARC/1.1\r\nWARC-Type: ")
            size = int(re.search(rb"Content-Length: (\d+)", head)[1])
            assert data[size:size + 4] == b"\r\n\r\n"
            data, seen = data[size + 4:], seen + 1
    assert seen == len(rows)


def test_index_is_one_global_order(spark, monkeypatch):
    rows = [(i, f"http://h{i * 7 % 50}.example/", "p") for i in range(3000)]
    rows += [(i, "http://hot.example/", "p") for i in range(3000, 4500)] + [(None, "http://h1.example/", "p")] * 3
    df = spark.createDataFrame([(*r, "t", "s", 1) for r in rows], PAGES).repartition(6)
    monkeypatch.setattr(warc, "RUN_ROWS", 100)
    out = warc.archived(df)
    got = [(r.url_key, r.captured, r.page_id or -1) for r in out.collect()]
    assert got == sorted(got) and len(got) == len(rows)
    sizes = [r["n"] for r in out.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert max(sizes) < 0.6 * len(rows)  # a URL with a third of all captures is split


def test_loser_tree_merges_like_sorting():
    rng = random.Random(9)
    for k in (0, 1, 2, 3, 5, 8, 13):
        runs = [sorted((rng.randint(0, 30), i) for i in range(rng.choice([0, 1, 7, 40]))) for _ in range(k)]
        assert list(warc.LoserTree([iter(r) for r in runs])) == sorted(sum(runs, []))


def test_url_keys(spark):
    want = {"http://www.Example.com:80/A?b#c": "com,example)/a?b", "https://u@x.org": "org,x)/",
            "ftp://x.org:21/": "org:21,x)/", "": "", "example.net/a": "net,example)/a", None: ""}
    df = spark.createDataFrame([(u,) for u in want], "u string")
    assert {r.u: r.k for r in df.select("u", warc.url_key(F.col("u")).alias("k")).collect()} == want


def test_damaged_archives_are_told():
    reader = warc.Reader()
    text = warc.record(1, "u", "hello", 5, hashlib.sha1(b"hello").hexdigest(), None, False)
    (head, payload), = [x for line in text.encode().split(b"\r\n\r\n") for x in reader.feed(line)]
    reader.done()
    warc._capture(head, payload, "a", 0)
    with pytest.raises(ValueError, match="digest"):
        warc._capture(head, b"hallo", "a", 0)
    short = warc.Reader()
    list(short.feed(text.encode().split(b"\r\n\r\n")[0]))
    with pytest.raises(ValueError, match="ends within"):
        short.done()


def test_empty_pages(spark):
    assert warc.archived(spark.createDataFrame([], PAGES)).collect() == []
