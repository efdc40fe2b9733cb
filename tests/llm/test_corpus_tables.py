"""Chat formatting, phrase collocations and source divergence: against plain Python and on awkward rows."""

import random
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from helpers_llm import awkward, empty
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidewatch.llm import chat, collocations, divergence, queries

CHAT = "conv_id long, turn long, role string, text string, h string"
SAID = ["", None, "</s>[INST] ok [/INST]", "[\\INST] <\\\\/s> [NEXT][", "é😀 [ROLE:41] x [/ROLE]", "line\nline", "[SYS] a [/SYS]\\", "<", "</s", "﻿x"]


def conversations(spark, rows):
    return spark.createDataFrame([(*r, "x") for r in rows], CHAT)


def test_chats_come_back_and_their_loss_is_what_the_assistant_said(spark):
    rng, rows = random.Random(4), []
    for conv in [*range(60), None]:
        for turn in rng.sample(range(20), rng.randint(1, 12)):
            rows.append((conv, rng.choice([turn, turn, None]), rng.choice(["user", "assistant", "assistant", "system", "tool ü", None, "user"]), rng.choice(SAID)))
    rows += rows[:5]  # repeated rows
    formatted = chat.format_chats(conversations(spark, rows))
    assert formatted.columns == ["conv_id", "messages", "formatted", "loss_spans"]
    read = formatted.select(
        "conv_id", "messages", "formatted", "loss_spans", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")
    )
    want = defaultdict(list)
    for conv, turn, role, text in rows:
        want[conv].append((turn is None, turn or 0, (role or "").encode(), (text or "").encode()))
    got = read.collect()
    assert {r.conv_id for r in got} == set(want) and len(got) == len(want)
    for r in got:
        turns = [(role.decode(), text.decode()) for *_, role, text in sorted(want[r.conv_id])]
        assert [tuple(t) for t in r.turns] == turns
        assert r.loss == [t for role, t in turns if role == "assistant"]
        # Adjacent turns of a role are one message; spans in code points and in bytes say the same.
        assert [m.role for m in r.messages] == [role for i, (role, _) in enumerate(turns) if not i or turns[i - 1][0] != role]
        spans = [r.formatted[s.start : s.start + s.n_chars] for s in r.loss_spans]
        assert spans == [r.formatted.encode()[s.byte_start : s.byte_start + s.n_bytes].decode() for s in r.loss_spans]
        assert spans == [t for m in r.messages if m.role == "assistant" for t in m.texts]


def test_chats_empty_and_long(spark):
    assert chat.format_chats(spark.createDataFrame([], CHAT)).count() == 0
    rows = [(1, i, "user" if i % 3 else "assistant", f"text {i} </s>") for i in range(3000)] + [(2, 0, "assistant", "long " * 200_000)]
    formatted = chat.format_chats(conversations(spark, rows))
    got = {r.conv_id: r for r in formatted.select("conv_id", chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("l"), F.size(chat.read_turns(F.col("formatted"))).alias("n")).collect()}
    assert got[1].n == 3000 and got[1].l == [f"text {i} </s>" for i in range(0, 3000, 3)] and got[2].l == ["long " * 200_000]


def test_chats_use_no_python_worker(spark):
    plan = queries.op11_chat_format(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and plan.count("Exchange hash") == 1


def plain_phrases(rows, least, longest):
    """{lang: (words in all, {phrase as words: count})} by counting everything."""
    out = defaultdict(lambda: [0, Counter()])
    cut = str.maketrans(dict.fromkeys(".,;:!?\n\x0b\x0c\r", "\n"))
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    for text, lang in rows:
        for piece in (text or "").translate(lower).translate(cut).split("\n"):
            words = [w for w in piece.replace("\t", " ").split(" ") if w]
            own = out["und" if lang is None else lang]
            own[0] += len(words)
            for k in range(1, longest + 1):
                own[1].update(tuple(words[i : i + k]) for i in range(len(words) - k + 1))
    return {lang: (n, {p: c for p, c in f.items() if c >= least}) for lang, (n, f) in out.items()}


def plain_collocations(rows, least, longest, top, absorb):
    out = []
    for lang, (n, f) in plain_phrases(rows, least, longest).items():
        found = []
        for p, a in f.items():
            if len(p) == 1 or any(len(q) > len(p) and 100 * b >= absorb * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in f.items()):
                continue
            score, _, left, right = min((1000 * a * n // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), left, right))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(found)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, n, -score))
    return sorted(out)


WORDS = ["a", "B", "the", "The", "é", "x\x00y", "日本", "[", "of", "ſ", "K"]


@pytest.mark.parametrize("options", [{}, {"trie_phrases": 3}, {"vocabulary": 0}, {"trie_phrases": 2, "vocabulary": 1}, {"absorb": 60, "top": 5}, {"longest": 3}])
def test_collocations_by_brute_force(spark, options):
    rng, rows = random.Random(11), []
    for _ in range(400):
        words = [rng.choice(WORDS[: rng.choice([3, 6, 11])]) + rng.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n"]) for _ in range(rng.randint(0, 30))]
        rows.append(("".join(words) + rng.choice(["", " of the a", "of the a B"]), rng.choice(["en", "en", "de", None, ""])))
    rows += [(None, "en"), ("", None), ("a b " * 3000, "hot"), (" \t ", "blank")] + rows[:20]
    docs = spark.createDataFrame(rows, "text string, lang string").withColumn("phrase", F.lit("taken")).withColumn("n", F.lit(1)).repartition(7)
    settings = {"least": 12, "longest": 5, "top": 2000, "absorb": 100} | options
    got = sorted(map(tuple, collocations.collocations(docs, **settings).collect()))
    assert got == plain_collocations(rows, *(settings[k] for k in ("least", "longest", "top", "absorb"))) and len(got) > 20


def test_collocations_of_awkward_rows(spark):
    got = collocations.collocations(awkward(spark)).collect()
    assert {r.lang for r in got} == {"en"} and all(r.a >= 100 for r in got)
    assert collocations.collocations(empty(spark)).count() == 0


@settings(max_examples=60, deadline=None)
@given(st.sets(st.tuples(st.sampled_from(["en", "de"]), st.lists(st.sampled_from([b"a", b"b", b"c", b"d"]), min_size=3, max_size=3).map(tuple)), min_size=1), st.lists(st.sampled_from([b"a", b"b", b"c", b"d", b"z"])))
def test_double_array_finds_all_phrases(phrases, text):
    listing = sorted((lang, b" ".join(words)) for lang, words in phrases)
    trie = collocations.DoubleArray.build(listing, 3)
    codes = collocations.Codes(trie.words, False)(text)
    for lang in ("en", "de", "fr"):
        at, number = trie.ends(lang, codes)
        got = [(int(i), trie.phrases[n]) for i, n in zip(at, number, strict=True)]
        assert got == [(i, (lang, b" ".join(text[i : i + 3]))) for i in range(len(text) - 2) if (lang, b" ".join(text[i : i + 3])) in listing]


def test_double_array_of_many_phrases():
    rng = np.random.default_rng(2)
    words = [f"w{i}".encode() for i in range(3000)]
    pairs = sorted({("en", words[a] + b" " + words[b]) for a, b in zip((rng.zipf(1.3, 60_000) % 3000).tolist(), rng.integers(0, 3000, 60_000).tolist(), strict=True)})
    trie = collocations.DoubleArray.build(pairs, 2)
    assert len(trie.base) < 40 * len(pairs) and (trie.accept >= 0).sum() == len(pairs)
    text = b" \n ".join(p for _, p in pairs).split(b" ")
    at, number = trie.ends("en", collocations.Codes(trie.words, False)(text))
    assert number.tolist() == list(range(len(pairs)))


def plain_divergence(rows, least, top):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, documents = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        terms = "".join(c if c.isascii() and c.isalpha() or ord(c) > 127 else " " for c in (text or "")).translate(lower).split(" ")
        terms = [t for t in terms if t]
        counts[lang or "", source or ""].update(terms)
        documents[lang or ""].update(set(terms))
    out = []
    for lang in documents:
        kept = [t for t, n in documents[lang].items() if n >= least]
        own = {s: c for (of, s), c in counts.items() if of == lang}
        every = sum(own.values(), Counter())

        def shares(c):
            return {t: 1 + 10**9 * (c[t] + 2) // (sum(c[k] for k in kept) + 2 * len(kept)) for t in kept}

        share, q = {s: shares(c) for s, c in own.items()}, shares(every)
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s in own:
            pairs = [(-sum(f(share[s][t], share[o][t]) for t in kept), o.encode()) for o in own if o != s]
            terms = [(-f(share[s][t], q[t]), t.encode()) for t in kept if own[s][t] > 0 and share[s][t] > q[t]]
            for part, found in (("pair", sorted(pairs)), ("term", sorted(terms)[:top])):
                out += [(lang, s, part, item.decode(), -value, rank) for rank, (value, item) in enumerate(found, 1)]
    return sorted(out)


@pytest.mark.parametrize("options", [{}, {"block": 2}, {"block": 3, "part_terms": 4}, {"min_documents": 1, "top_terms": 3}, {"min_documents": 10**6}])
def test_divergence_by_brute_force(spark, options, monkeypatch):
    rng, rows = random.Random(13), []
    terms = ["a", "B", "b", "é", "É", "日本", "zz", "q", "word", "Word", "ſ", "İ"] + [f"t{chr(97 + i)}" for i in range(20)]
    for _ in range(300):
        of = rng.choice([0, 0, 5, 12])
        rows.append((rng.choice([" ", "1", "-"]).join(rng.choice(terms[of:]) for _ in range(rng.randint(0, 25))), rng.choice(["en", "en", "de", None]), rng.choice(["s1", "s2", "s3", "s9", "ü", None, ""])))
    rows += [(None, "en", "none"), ("123 _", "xx", "y"), ("123", "xx", "z"), ("lonely", "yy", "only")] + rows[:30]
    docs = spark.createDataFrame(rows, "text string, lang string, source string").withColumn("term", F.lit("taken")).withColumn("part", F.lit(3)).repartition(5)
    got = sorted(map(tuple, divergence.source_divergence(docs, **options).collect()))
    assert got == plain_divergence(rows, options.get("min_documents", 10), options.get("top_terms", 10))


def test_divergence_in_small_chunks(spark):
    """Postings that come in many batches and chunks give the same sums."""
    rng = np.random.default_rng(3)
    one, two = rng.integers(1, 10**9, 7), rng.integers(1, 10**9, 5)
    term = np.sort(rng.integers(0, 40, 200))
    right = rng.random(200) < 0.4
    slot = np.where(right, rng.integers(0, 5, 200), rng.integers(0, 7, 200))
    keep = np.unique(np.stack([term, right, slot]), axis=1)
    term, right, slot = keep[0], keep[1] == 1, keep[2]
    share = rng.integers(1, 10**9, len(term))
    sums = divergence.PairSums(one, two, False)
    for t in np.unique(term):
        here = term == t
        sums.add(term[here], right[here], slot[here], share[here])
    p, q = np.tile(one, (40, 1)), np.tile(two, (40, 1))
    p[term[~right], slot[~right]], q[term[right], slot[right]] = share[~right], share[right]
    want = divergence.divergence(p[:, :, None], q[:, None, :]).sum(axis=0)
    assert (sums.sums + 40 * sums.base == want).all()


def test_divergence_of_awkward_rows(spark):
    got = divergence.source_divergence(awkward(spark), min_documents=1).collect()
    assert {(r.lang, r.source) for r in got} >= {("en", "a"), ("", ""), ("de", "c")} and all(r.value >= 0 for r in got)
    assert divergence.source_divergence(empty(spark)).count() == 0


def test_shares_beyond_64_bits(spark):
    rows = spark.createDataFrame([(10**13, 3 * 10**13, 5), (9 * 10**17, 9 * 10**17 + 7, 10**6)], "n long, total long, terms long")
    got = [r.p for r in rows.select(divergence._share("n", "total", "terms").alias("p")).collect()]
    assert got == [1 + 10**9 * (n + 2) // (total + 2 * v) for n, total, v in ((10**13, 3 * 10**13, 5), (9 * 10**17, 9 * 10**17 + 7, 10**6))]


@pytest.mark.parametrize("together, held", [(1, 1), (7, 3), (50, 10)])
def test_counts_handed_on_in_small_parts(monkeypatch, together, held):
    """Tasks that may hold next to nothing give the same sums, in more rows."""
    monkeypatch.setattr(collocations, "_TOGETHER", together)
    monkeypatch.setattr(collocations, "_HELD", held)
    monkeypatch.setattr(collocations, "_CUT", 5)
    monkeypatch.setattr(divergence, "_HELD", held)
    monkeypatch.setattr(divergence, "_CUT", 5)
    rng = random.Random(8)
    rows = [("".join(rng.choice(["a", "B", "c", "dd"]) + rng.choice([" ", " ", ".", "\t"]) for _ in range(40)), rng.choice(["en", "de"])) for _ in range(30)]
    want = {lang: f for lang, (_, f) in plain_phrases(rows, 1, 3).items()}

    def batches():
        for i in range(0, len(rows), 7):
            part = rows[i : i + 7]
            yield pa.RecordBatch.from_arrays([pa.array([r[1] for r in part]), pa.array([r[0].encode() for r in part], pa.binary())], names=["lang", "text"])

    def summed(out, counted):
        total = defaultdict(Counter)
        for batch in out:
            for r in batch.to_pylist():
                if r["counted"] == counted:
                    total[r["lang"]][tuple(r["phrase"].split(" "))] += r["n"]
        return total

    def of_length(k):
        return {lang: {p: n for p, n in f.items() if len(p) == k} for lang, f in want.items()}

    assert summed(collocations._count_words(batches()), True) == of_length(1)
    words = {lang: sorted({w.encode() for p in f for w in p}) for lang, f in want.items()}
    for listed in (words, None):
        assert summed(collocations._pair_counter(lambda listed=listed: listed)(batches()), False) == of_length(2)
    trie = collocations.DoubleArray.build(sorted((lang, " ".join(p).encode()) for lang, f in want.items() for p in f if len(p) == 2), 2)
    for whole in (True, False):
        out = list(collocations._phrase_counter(lambda: trie, whole, True)(batches()))
        assert summed(out, True) == of_length(2) and summed(out, False) == of_length(3)

    def terms():
        for batch in batches():
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(0), batch.column(1)], names=["lang", "source", "text"])

    found, documents = defaultdict(Counter), defaultdict(Counter)
    for batch in divergence._count_terms(terms()):
        for r in batch.to_pylist():
            found[r["lang"]][r["term"]] += r["n"]
            documents[r["lang"]][r["term"]] += r["docs"]
    lower = [(t.lower().replace("\t", " ").replace(".", " ").split(), lang) for t, lang in rows]
    for lang in found:
        assert {t: n for t, n in found[lang].items() if t} == Counter(w for ws, of in lower if of == lang for w in ws)
        assert {t: n for t, n in documents[lang].items() if t} == Counter(w for ws, of in lower if of == lang for w in set(ws))
