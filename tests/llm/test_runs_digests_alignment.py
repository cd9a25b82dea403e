"""Operators 11 to 13 against brute force, with awkward inputs."""

import collections
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tests.llm.test_operators import LONG, SCHEMA, TEXTS, docs, empty, odd, texts  # noqa: F401
from vocatio.llm import alignment, digest_index, periodic_runs, queries
from vocatio.sources.folders import fresh_folder

UNIQUE = " ".join(f"u{i}" for i in range(100_000))


# --- 11 -----------------------------------------------------------------------


def slow_runs(words):
    """Every period in turn: stretches of words equal to those q before; the least period of each counts."""
    found = {}
    for q in range(1, len(words)):
        i = 0
        while i + q < len(words):
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j > i and j - i + q >= max(12, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j + 1
    return sorted((s, n, q) for (s, n), q in found.items())


def without(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def periodic(draw, n, letters):
    words = [draw.randrange(letters) for _ in range(n)]
    if draw.random() < 0.5:
        a = draw.randrange(n)
        p = 1 + (n - a) // draw.randint(2, 9)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    return words


def test_runs_of_random_words_are_all_found():
    draw = random.Random(5)
    for _ in range(1500):
        words = periodic(draw, draw.randint(1, 90), draw.choice([1, 2, 2, 3, 5]))
        values = np.array(words, np.uint64)
        expected = slow_runs(words)
        assert periodic_runs.runs_of(values) == expected
        cut = periodic_runs.recurring_stretches(values, np.zeros(len(words), np.int64))
        inside = [(s + int(a), n, q) for a, b in zip(*cut) for s, n, q in periodic_runs.runs_of(values[a:b])]
        assert sorted(inside) == expected


def test_stretches_keep_texts_apart():
    words = np.array([1, 2, 3, 4, 5, 6] * 2, np.uint64)
    both = periodic_runs.recurring_stretches(words, np.array([0] * 12))
    assert [x.tolist() for x in both] == [[0], [12]]
    apart = periodic_runs.recurring_stretches(words, np.array([0] * 6 + [1] * 6))
    assert [x.tolist() for x in apart] == [[], []]


def test_runs_of_documents(spark, odd, empty):  # noqa: F811
    draw = random.Random(6)
    some = [(100 + k, "  ".join(map(str, periodic(draw, 80, 3))), None, None, 0, "", 0) for k in range(60)]
    some.append((200, " ".join(["a b c d e f g"] * 4000), None, None, 0, "", 0))
    some.append((201, LONG + " " + "x y " * 9 + UNIQUE, None, None, 0, "", 0))
    frame = odd.unionByName(spark.createDataFrame(some, SCHEMA)).repartition(3)
    rows = periodic_runs.periodic_runs(frame).collect()
    assert len(rows) == len(TEXTS) + len(some)
    own = collections.defaultdict(set)
    for r in rows:
        own[r["doc_id"]].add((r["n_words"], tuple((x["start"], x["length"], x["period"]) for x in r["runs"]), r["collapsed"]))
    for row in some[:60]:
        words = row[1].split()
        runs = slow_runs(words)
        assert own[row[0]] == {(len(words), tuple(runs), without(words, runs))}
    assert own[200] == {(28000, ((0, 28000, 7),), "a b c d e f g")}
    (n, runs, collapsed), = own[201]
    period = 997 * 31  # of the words of LONG
    once = " ".join(LONG.split()[:period])
    assert (n, runs) == (400_018, ((0, 300_000, period), (300_000, 18, 2))) and collapsed == f"{once} x y {UNIQUE}"
    assert own[3] == own[4] == own[5] == {(0, (), "")}
    assert own[8] == {(300_000, ((0, 300_000, period),), once)}
    assert periodic_runs.periodic_runs(empty).count() == 0


def test_planted_runs_follow_their_rule(spark, docs):  # noqa: F811
    import zlib

    frame = docs.select("doc_id", "text").unionByName(spark.createDataFrame([(None, "a b"), (31, None), (42, "")], "doc_id long, text string"))
    before = collections.defaultdict(set)
    for r in frame.collect():
        before[r["doc_id"]].add(r["text"])
    changed = 0
    for r in queries.with_planted_runs(frame).collect():
        h = zlib.crc32(str(r["doc_id"]).encode()) if r["doc_id"] is not None else 0
        expected = set()
        for text in before[r["doc_id"]]:
            words, g = (text or "").split(), h // 10
            if h % 10 == 0 and words:
                n = len(words)
                a = g % n
                p = 1 + (n - a) // (3 + g % 8)
                text = " ".join(words[i] if i < a else words[a + (i - a) % p] for i in range(n))
                changed += 1
            expected.add(text)
        assert r["text"] in expected
    assert changed > 5


# --- 12 -----------------------------------------------------------------------


def test_filter_holds_inserts_and_forgets_deletes():
    draw = np.random.default_rng(1)
    keys = np.unique(draw.integers(-(1 << 63), 1 << 63, 5000))
    held = digest_index.CuckooFilter.of(keys[:4000])
    assert all(held.contains(*p) for p in held.places(keys[:4000]))
    again = digest_index.CuckooFilter.from_bytes(held.as_bytes())
    for place in again.places(keys[:2000]):
        assert again.delete(*place)
    assert all(again.contains(*p) for p in again.places(keys[2000:4000]))
    assert sum(again.contains(*p) for p in again.places(keys[:2000])) < 20
    assert sum(held.contains(*p) for p in held.places(keys[4000:])) < 10


def test_full_filter_is_refused_and_larger_ones_hold_all():
    keys = np.arange(1, 200, dtype=np.int64) * 0x9E3779B97F4A7C1
    small = digest_index.CuckooFilter(16)
    assert not all(small.insert(*p) for p in small.places(keys))
    grown = digest_index.CuckooFilter.of(keys)
    assert grown.buckets > 16 and all(grown.contains(*p) for p in grown.places(keys))


def slow_groups(rows):
    ids = collections.defaultdict(list)
    lower = [(i, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or "")) for i, t in rows]
    for i, t in lower:
        ids[t].append(i)
    found = []
    for i, t in lower:
        keep = max((k for k in ids[t] if k is not None), default=None)
        sha = hashlib.sha256(t.encode()).hexdigest()
        found.append((i, keep, len(ids[t]), i is not None and i == keep, sha))
    return sorted(found, key=str)


def groups(index):
    return sorted((tuple(r) for r in index.groups().collect()), key=str)


@pytest.mark.parametrize("digest", [digest_index.first_bytes, lambda text, sha: len(text) % 3])
def test_groups_over_batches_and_deletes(spark, odd, empty, digest):  # noqa: F811
    """The second digest is the same for many texts, so that all rests on the verification."""
    folder = fresh_folder(spark, "index")
    index = digest_index.DigestIndex(spark, folder, shards=3, digest=digest)
    index.insert(empty)
    assert index.groups().count() == 0
    rows = [(i, t) for i, t in TEXTS]
    index.insert(odd)
    assert groups(index) == slow_groups(rows)
    more = [(50, "SHORT text"), (51, "short texT"), (52, ""), (53, "new"), (54, LONG), (None, "one two three"), (2, "new")]
    index.insert(spark.createDataFrame(more, "doc_id long, text string"))
    rows += more
    assert groups(index) == slow_groups(rows)
    index.delete(spark.createDataFrame([(54,), (51,), (50,), (10,), (None,)], "doc_id long"))
    rows = [r for r in rows if r[0] not in (54, 51, 50, 10)]
    assert groups(index) == slow_groups(rows)
    index = digest_index.DigestIndex.open(spark, folder, shards=3, digest=digest)
    index.delete(spark.createDataFrame([(10,), (53,), (2,)], "doc_id long"))  # 10 is gone already
    index.insert(spark.createDataFrame([(10, "x" * 3000), (60, "NEW"), (53, "other")], "doc_id long, text string"))
    rows = [r for r in rows if r[0] not in (53, 2)] + [(10, "x" * 3000), (60, "NEW"), (53, "other")]
    assert groups(index) == slow_groups(rows)


def test_filters_overflow_and_grow(spark):
    rows = [(k, f"text {k % 700}") for k in range(1500)]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    index = digest_index.DigestIndex(spark, fresh_folder(spark, "index"), shards=2)
    index.insert(frame.filter("doc_id < 600"))
    index.insert(frame.filter("doc_id >= 600"))
    assert groups(index) == slow_groups(rows)
    state = spark.read.parquet(f"{index.commits[-1][1]}/filters").filter("marks IS NOT NULL")
    assert min(len(r["marks"]) for r in state.collect()) >= 350 * 2


def test_uncommitted_batches_are_not_read(spark):
    folder = fresh_folder(spark, "index")
    index = digest_index.DigestIndex(spark, folder)
    index.insert(spark.createDataFrame([(1, "a"), (2, "A")], "doc_id long, text string"))
    lost = digest_index.DigestIndex.open(spark, folder)
    lost._commit = lambda *_: None  # the driver ends before the commit
    lost.insert(spark.createDataFrame([(3, "a")], "doc_id long, text string"))
    again = digest_index.DigestIndex.open(spark, folder)
    assert groups(again) == slow_groups([(1, "a"), (2, "A")])


def test_texts_are_shuffled_beyond_the_broadcast(spark, odd, monkeypatch):  # noqa: F811
    monkeypatch.setattr(digest_index, "MOST_BROADCAST", 0)
    found = digest_index.exact_duplicates(odd, fresh_folder(spark, "index"), batches=3)
    assert sorted((tuple(r) for r in found.collect()), key=str) == slow_groups(TEXTS)


# --- 13 -----------------------------------------------------------------------


@pytest.fixture(scope="module")
def pair():
    return alignment.Pair(queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model"))


class Slow:
    """Alignment of a whole text by the spans of its tokens."""

    def __init__(self, pair):
        from tokenizers import Tokenizer

        self.pair = pair
        self.first = Tokenizer.from_file(queries.tokenizer_path())
        self.first.encode_special_tokens = True

    def tokens(self, text):
        if not text:
            return [], []
        a = self.first.encode(" " + text, add_special_tokens=False).ids
        b = self.pair.second.encode(text)
        spelled = [b"".join(t[k] for k in ids) for t, ids in ((self.pair.a_bytes, a), (self.pair.b_bytes, b))]
        return (a, b) if spelled[0] == spelled[1] == (" " + text).encode() else ([], [])

    @staticmethod
    def spans(ids, of):
        found, at = [], 0
        for k in ids:
            found.append((at, at + len(of[k])))
            at += len(of[k])
        return found

    def __call__(self, text):
        a, b = self.tokens(text)
        of_a, of_b = self.spans(a, self.pair.a_bytes), self.spans(b, self.pair.b_bytes)
        groups, low = [], 0
        for end in sorted({e for _, e in of_a} & {e for _, e in of_b}):
            sides = [[k for k, (_, e) in zip(ids, spans) if low < e <= end] for ids, spans in ((a, of_a), (b, of_b))]
            groups.append("|".join(",".join(map(str, side)) for side in sides))
            low = end
        links = collections.Counter()
        first = 0
        for i, (s, e) in zip(a, of_a):
            while first < len(of_b) and of_b[first][1] <= s:
                first += 1
            for j, (u, v) in zip(b[first:], of_b[first:]):
                if u >= e:
                    break
                links[i << 32 | j] += 1
        return len(a), len(b), groups, links


PARTS = [
    "a", "the", "Hello", "1234", " ", "  ", "\n", "\n\n", "\t", "é", "日本語", "\U0001F600", "<|endoftext|>", "</s>", "▁",
    "don't", " ", "　", "x.y,", "!!", "\x1c", "\0", "ing", "  foo", "\r\n", "_",
]


def test_cells_and_fragments_of_random_texts(pair):
    draw, slow = random.Random(2), Slow(pair)
    for _ in range(1500):
        text = "".join(draw.choice(PARTS) for _ in range(draw.randint(1, 14)))
        n_a, n_b, groups, links = slow(text)
        cells = alignment.cells_of(text)
        assert "".join(cells) == " " + text
        pair.learn(set(cells))
        found = [pair.known[c] for c in cells]
        if not all(f[5] for f in found):
            found = []
        assert (sum(f[0] for f in found), sum(f[1] for f in found)) == (n_a, n_b)
        assert ";".join(f[3] for f in found) == ";".join(groups)
        if not n_a:
            continue
        a, b = slow.tokens(text)
        of_a, of_b = slow.spans(a, pair.a_bytes), slow.spans(b, pair.b_bytes)
        size = of_a[-1][1]
        cuts = [0, *sorted(draw.sample(range(size + 1), min(size, draw.randint(0, 5)))), size]
        parts = []
        for low, high in zip(cuts, cuts[1:]):  # ranges that begin and end inside of tokens
            x = [k for k, (_, e) in enumerate(of_a) if low < e <= high]
            y = [k for k, (_, e) in enumerate(of_b) if low < e <= high]
            ahead = of_b[y[0]][0] - of_a[x[0]][0] if x and y else 0
            sizes = [[s[k][1] - s[k][0] for k in ks] for s, ks in ((of_a, x), (of_b, y))]
            parts.append(alignment.fragment_of([a[k] for k in x], sizes[0], [b[k] for k in y], sizes[1], ahead))
        while len(parts) > 1:  # in any order
            k = draw.randrange(len(parts) - 1)
            parts[k : k + 2] = [alignment.compose(parts[k], parts[k + 1])]
        whole = alignment.finished(parts[0])
        assert (whole.groups, whole.n_groups, whole.links) == (";".join(groups), len(groups), dict(links))


@pytest.mark.parametrize("broadcast", [True, False])
def test_documents_and_counts(spark, odd, empty, texts, pair, monkeypatch, broadcast):  # noqa: F811
    monkeypatch.setattr(alignment, "RANGE_CHARS", 700)  # most documents in ranges, some in several rounds
    monkeypatch.setattr(alignment, "FAN", 3)
    if not broadcast:
        monkeypatch.setattr(alignment, "MOST_BROADCAST", 0)
    rows = [(i, t) for i, t in TEXTS if t is None or len(t) < 10_000]
    rows += [(1000 + i, t) for i, t in sorted(texts.items())[:25]]
    rows += [(2000, "日本語" * 900), (2001, "no▁ " * 400), (2002, "<|endoftext|> </s>\n" * 60)]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    slow = Slow(pair)
    expected = [(i, *slow(t)) for i, t in rows]
    counts = collections.Counter(p for _, _, _, _, links in expected for p in links)
    most: dict = {}
    for p, n in counts.items():
        most[p >> 32] = max(n, most.get(p >> 32, 0))
    want = sorted(
        (
            (i, a, b, len(g), sum(k.values()), sum(n for p, n in k.items() if counts[p] == most[p >> 32]),
             sum(n * counts[p] for p, n in k.items()), ";".join(g))
            for i, a, b, g, k in expected
        ),
        key=str,
    )
    found = alignment.align(frame, queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model"))
    found = alignment.with_counts(found)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_all", "n_best", "count_sum", "groups"]
    assert sorted((tuple(r) for r in found.select(*names).collect()), key=str) == want
    none = alignment.align(empty, queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model"))
    assert alignment.with_counts(none).count() == 0


def test_long_document_equals_itself_in_one_piece(spark, odd, pair):  # noqa: F811
    """The longest text goes through ranges of production size."""
    paths = queries.tokenizer_path(), queries.tokenizer_path("piece_bpe_32k.model")
    row = alignment.align(odd.filter("doc_id = 8"), *paths).collect()[0]
    pair.learn(set(alignment.cells_of(LONG)))
    cells = [pair.known[c] for c in alignment.cells_of(LONG)]
    assert row["groups"] == ";".join(c[3] for c in cells)
    assert (row["n_a"], row["n_b"], row["n_groups"]) == tuple(sum(c[k] for c in cells) for k in (0, 1, 2))


def test_alignment_query_has_its_columns(spark):
    found = queries.op13_alignment(spark, "/root/testdata/sf0.001")
    assert found.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert found.filter(F.col("n_best") > F.col("n_links")).count() == 0 and found.filter("n_links > 0").count() > 0
