"""Operators that compare rows: against brute force on driver data, and on awkward rows."""

import hashlib
import re
from collections import defaultdict

import duckdb
import pytest
from helpers_llm import awkward, empty
from pyspark.sql import functions as F

from conftest import TINY
from tidewatch.llm import components, decontaminate, fingerprints, jaccard_join, queries, url_lists

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def groups(links, nodes):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize(
    "edges",
    [
        [],
        [(1, 1)],
        [(1, 2), (2, 3), (5, 4), (3, 2)],
        [(i, i + 1) for i in range(200)],
        [(0, i) for i in range(300)] + [(1000 + i, i) for i in range(300)],
        [(7, 3), (3, 9), (9, 7), (20, 21)],
    ],
)
def test_connected(spark, edges):
    got = {r.node: r.label for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    real = [e for e in edges if e[0] != e[1]]
    assert got == groups(real, {n for e in real for n in e})


def test_connected_with_hubs(spark):
    """Hubs of least and of greatest number, a chain between them, repeated edges and a leaf that two hubs share."""
    low, high = [(0, n) for n in range(1000, 1400)], [(n, 9999) for n in range(2000, 2300)]
    chain = [(n, n + 1) for n in range(3000, 3040)]
    edges = [*low, *low, *high, *chain, (1399, 3000), (3040, 2000), (5000, 6000), *[(7000, n) for n in range(7001, 7100)], *[(n, 8000) for n in range(7050, 7200)]]
    got = {r.node: r.label for r in components.connected(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == groups(edges, {n for e in edges for n in e}) and len(set(got.values())) == 3


def test_check_sql(spark):
    con = duckdb.connect()
    for name in ("documents", "benchmark", "pages"):
        con.execute(f"create view {name} as from '{TINY}/{name}.parquet'")
    for name, sql in queries.SQL.items():
        want = con.execute(sql)
        columns = [c[0] for c in want.description]
        got = queries.QUERIES[name](spark, TINY).select(columns).collect()
        key = lambda r: [str(v) for v in r]
        assert sorted(map(tuple, got), key=key) == sorted(want.fetchall(), key=key)


def hits(text, items, window=13):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    hit, found = set(), set()
    for item, body in items:
        own = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), body or ""))
        k = min(window, len(own))
        wins = {tuple(own[i : i + k]) for i in range(len(own) - k + 1)} if own else set()
        for i in range(len(words) - k + 1):
            if k and tuple(words[i : i + k]) in wins:
                hit |= set(range(i, i + k))
                found.add(item)
    return len(words), len(hit), sorted("" if i is None else str(i) for i in found)


def test_contamination_of_awkward_rows(spark):
    items = [
        (10, "quick brown fox"), (2, "Dog"), (None, "id at all"), (4, None), (5, ""), (6, "..."), (7, "word salad of very many words " * 5),
        (10, "quick brown fox"), (11, "ÜBER öl"), (12, "über öl"), (13, "very many words word salad of very many nothing words word salad of very many"),
    ]
    docs = awkward(spark)
    for limit in (10**6, 0):
        got = decontaminate.find_contamination(docs, spark.createDataFrame(items, "item_id long, text string"), keep=("doc_id", "text"), broadcast_rows=limit).collect()
        assert len(got) == 12
        for r in got:
            assert (r.n_words, r.n_hit, r["items"]) == hits(r.text, items), r.text and r.text[:40]
    none = decontaminate.find_contamination(docs, spark.createDataFrame([], "item_id long, text string")).collect()
    assert len(none) == 12 and not any(r.n_hit for r in none)
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert decontaminate.find_contamination(empty(spark), bench).count() == 0
    clean = decontaminate.without_contaminated(docs, bench)
    assert clean.columns == docs.columns
    bad = [r for r in docs.collect() if (lambda w, h, _: h > 0 and 20 * h >= w)(*hits(r.text, items))]
    assert clean.count() == 12 - len(bad)


def grams(text, n=5):
    words = WORD.findall((text or "").lower())
    k = min(n, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def near_pairs(sets):
    where = defaultdict(list)
    for i, s in sets.items():
        for g in s:
            where[g].append(i)
    pairs = set()
    for i, s in sets.items():
        for j in {j for g in s for j in where[g] if j > i}:
            if len(s & sets[j]) >= 0.8 * len(s | sets[j]) - 1e-9:
                pairs.add((i, j))
    return pairs


def test_bands_reach_the_recall():
    for recall in (0.9, 0.99, 0.9999):
        bands, rows = jaccard_join.choose_bands(0.8, recall)
        assert (1 - 0.8**rows) ** bands <= 1 - recall and bands * rows <= 160


def test_near_duplicates_by_brute_force(spark):
    folder = TINY.replace("0.001", "0.01")
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    sets = {i: grams(t) for i, t in docs.items()}
    pairs = near_pairs(sets)
    label = groups(pairs, docs)
    links = defaultdict(int)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    got = queries.op8_jaccard_join(spark, folder).collect()
    assert len(got) == len(docs) and pairs
    for r in got:
        assert (r.class_id, r.n_links, r.keeper) == (label[r.doc_id], links[r.doc_id], label[r.doc_id] == r.doc_id)


@pytest.mark.parametrize("block, limit", [(8, 0), (512, 10**6)])
def test_a_large_group_in_blocks_has_all_its_links(spark, block, limit):
    words = [f"w{i}" for i in range(60)]
    texts = [" ".join(words[:i] + [f"x{i}"] + words[i + 1 :]) for i in range(40)] + [" ".join(words)] * 5
    docs = {i: t for i, t in enumerate(texts)}
    pairs = near_pairs({i: grams(t) for i, t in docs.items()})
    got = jaccard_join.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string"), block=block, broadcast_rows=limit).collect()
    links = defaultdict(int)
    for a, b in pairs:
        links[a] += 1
        links[b] += 1
    label = groups(pairs, docs)
    assert {r.doc_id: (r.n_links, r.class_id) for r in got} == {i: (links[i], label[i]) for i in docs}


def test_near_duplicates_of_awkward_rows(spark):
    docs = awkward(spark)
    got = jaccard_join.near_duplicates(docs).collect()
    assert len(got) == 12
    by_id = {r.doc_id: r for r in got if r.doc_id is not None}
    assert by_id[2].class_id == by_id[1].class_id == 1 and not by_id[2].keeper and by_id[1].n_links == 1
    assert all(by_id[i].keeper and by_id[i].n_links == 0 for i in (3, 4, 5, 6, 7, 8, 9))
    kept = jaccard_join.one_per_class(docs)
    assert kept.columns == docs.columns and kept.count() == 10
    assert jaccard_join.near_duplicates(empty(spark)).count() == 0 and jaccard_join.one_per_class(empty(spark)).count() == 0


def test_fingerprints_by_brute_force(spark):
    docs = sorted(((r.doc_id, r.text) for r in spark.read.parquet(f"{TINY}/documents.parquet").collect()), reverse=True)
    got = {r.doc_id: r for r in queries.op4_fingerprints(spark, TINY).collect()}
    assert len(got) == len(docs)
    for (i, t), (_, following) in zip(docs, docs[1:] + docs[:1], strict=True):
        cut = len(t) // 3
        changed = t[: len(t) - cut] + following[:cut]
        own, other, after = (fingerprints.order_minhash(x) for x in (t, changed, following))
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(changed.encode()).hexdigest())
        assert r.fingerprint == own.astype(">u2").tobytes().hex() and r.edited_fingerprint == other.astype(">u2").tobytes().hex()
        assert (r.near_edited, r.near_next) == (fingerprints.likeness(own, other), fingerprints.likeness(own, after))


@pytest.mark.parametrize("buckets", [1, 3, 1000])
def test_fingerprints_of_awkward_rows(spark, buckets):
    docs = awkward(spark)
    order = sorted(((r.doc_id, r.text or "") for r in docs.collect()), key=lambda r: (r[0] is None, -(r[0] or 0), r[1]))
    want = sorted(str((a[0], len(a[1]), fingerprints.edited(a[1], b[1]))) for a, b in zip(order, order[1:] + order[:1], strict=True))
    got = fingerprints.fingerprint_neighbours(docs, buckets=buckets).collect()
    assert sorted(str((r.doc_id, r.n_chars, r.edited_text)) for r in got) == want
    assert fingerprints.fingerprint_neighbours(empty(spark)).count() == 0
    one = fingerprints.fingerprint_neighbours(docs.where("doc_id = 8")).collect()
    assert len(one) == 1 and one[0].near_next == 1


def order_minhash_plainly(text, k, size, slots):
    """The docstring of order_minhash in whole numbers, one k-mer at a time."""
    whole = (1 << 64) - 1
    base, m1, m2 = 0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB

    def mix(x):
        x = (x ^ (x >> 30)) * m1 & whole
        x = (x ^ (x >> 27)) * m2 & whole
        return x ^ (x >> 31)

    seen, codes = defaultdict(int), []
    k = min(k, len(text))
    for at in range(len(text) - k + 1):
        kmer = text[at : at + k]
        code = 0
        for c in kmer:
            code = (code * base + ord(c)) & whole
        code, again = mix(code), seen[kmer]
        codes.append((mix((code + again * m2) & whole) if again else code, at))
        seen[kmer] += 1
    circle, out = sorted(codes), []
    for slot in range(slots):
        edge = slot * ((1 << 64) // slots)
        first = next((i for i, (code, _) in enumerate(circle) if code >= edge), len(circle))
        chosen = [circle[(first + j) % len(circle)] for j in range(size)]
        value = 0
        for code, _ in sorted(chosen, key=lambda c: c[1]):
            value = mix((value * base + code) & whole)
        out.append(value >> 48)
    return out


@pytest.mark.parametrize("k, size, slots", [(9, 2, 64), (3, 3, 8), (1, 2, 5), (20, 1, 16)])
def test_order_minhash_by_a_plain_version(k, size, slots):
    texts = ["a", "abc", "abcabcabcabc" * 5, "aaaaaaaaaaaaaaaaaaaaaaaaa", "The quick brown fox jumps over the lazy dog. " * 3, "Ärger 😀 über Öl " * 9, "\x00\uffff"]
    for text in texts:
        assert fingerprints.order_minhash(text, k, size, slots).tolist() == order_minhash_plainly(text, k, size, slots)


def test_fingerprint_depends_on_order_and_on_occurrences():
    a, b = "abcdefghijklmnop" * 3, "qrstuvwxyz012345" * 3
    same = fingerprints.likeness(fingerprints.order_minhash(a + b), fingerprints.order_minhash(a + b))
    turned = fingerprints.likeness(fingerprints.order_minhash(a + b), fingerprints.order_minhash(b + a))
    assert same == 1 and turned < 0.9
    assert fingerprints.likeness(fingerprints.order_minhash("ab" * 50), fingerprints.order_minhash("ab" * 200)) < 0.9


def test_url_lists(spark):
    day = "timestamp'2024-05-{:02d} 12:00:00'"
    captures = spark.sql(
        "SELECT * FROM VALUES "
        f"(1L, 'https://U@A.B.example.com:8080/x/y?q#f', {day.format(1)}), (2L, 'http://a.b.example.com/x', {day.format(3)}),"
        f"(3L, 'http://b.example.com', {day.format(10)}), (3L, 'http://b.example.com', {day.format(10)}), (4L, NULL, {day.format(1)}),"
        f"(5L, 'nonsense', {day.format(1)}), (6L, 'http://b.example.com/', NULL), (NULL, 'http://other.org/x/', {day.format(1)}) AS t(page_id, url, fetched_at)"
    )
    entries = spark.createDataFrame(
        [
            ("example.com", "block", "2020-01-01"), ("b.example.com/x/", "allow", "2024-05-02"), ("B.example.com", "remove", "2024-05-09"),
            ("a.b.example.com/x", "allow", "2024-05-03"), ("a.b.example.com/x", "block", "2024-05-03"), (None, "block", "2020-01-01"),
            ("other.org/x", "block", "2024-05-02"), ("other.org", "what", "2020-01-01"), ("b.example.com", "allow", "2024-05-05"), ("x.org", "block", None),
        ],
        "pattern string, action string, dated string",
    )
    got = sorted((str(r.page_id), r.matched_pattern, r.action, r.blocked) for r in url_lists.filter_captures(captures, entries).collect())
    assert got == [
        ("1", "example.com", "block", True),
        ("2", "a.b.example.com/x", "block", True),
        ("3", "example.com", "block", True),
        ("3", "example.com", "block", True),
        ("4", None, None, False),
        ("5", None, None, False),
        ("6", None, None, False),
        ("None", None, None, False),
    ]
    assert url_lists.filter_captures(captures.limit(0), entries).count() == 0
    assert not any(r.blocked for r in url_lists.filter_captures(captures, entries.limit(0)).collect())
