"""Phrase collocations: Apriori levels counted with double-array tries, scored at their weakest cut.

Every level broadcasts tries of its candidates. A task advances the states of
all positions of its texts together, one word at a time, and counts accepting
states; Spark adds the counts of tasks and of tries.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidewatch.llm.common import prepare, stored

#: A piece ends at each of these; words end at blanks and tabs.
PIECE_ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
_BOUNDARY = b"\n"
_CLEAN = bytes.maketrans(PIECE_ENDS + b"\t", _BOUNDARY * len(PIECE_ENDS) + b" ")
#: Bytes of a text cut into words at a time; words that a task advances together; entries it holds before it hands them on.
_CUT, _TOGETHER, _HELD = 1 << 20, 1 << 18, 1 << 19

_FOUND = "lang string, phrase string, counted boolean, n long"


def words_of(text: bytes) -> Iterator[list[bytes]]:
    """Words of a UTF-8 text in order, A-Z lower-cased, with a line end wherever a piece ends; in parts of whole pieces."""
    rest = text.lower().translate(_CLEAN)
    start = 0
    while start < len(rest):
        end = rest.find(_BOUNDARY, start + _CUT) if start + _CUT < len(rest) else len(rest)
        end = len(rest) if end < 0 else end
        yield [w for w in rest[start:end].replace(_BOUNDARY, b" \n ").split(b" ") if w]
        start = end


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, list[bytes]]]:
    """(lang, words) of many texts at a time, the texts parted like pieces."""
    held: dict[str, list[bytes]] = {}
    for batch in batches:
        for lang, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            words = held.setdefault(lang, [])
            for part in words_of(text):
                words += part
                if len(words) > _TOGETHER:
                    yield lang, held.pop(lang)
                    words = held.setdefault(lang, [])
            words.append(_BOUNDARY)
    yield from held.items()


class Codes(dict):
    """Numbers of words from 1; any other word is 0, or gets the next number if ``more`` may come."""

    def __init__(self, words: list[bytes], more: bool):
        super().__init__(zip(words, range(1, len(words) + 1), strict=True))
        self.words, self.more = list(words), more
        self[_BOUNDARY] = 0

    def __missing__(self, word: bytes) -> int:
        if not self.more:
            return 0
        self.words.append(word)
        self[word] = len(self.words)
        return len(self.words)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))


class Keys:
    """Counts of 64-bit keys, summed up whenever many are held."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.held = 0

    def add(self, keys: np.ndarray) -> bool:
        """Whether so many different keys are held that they should be handed on."""
        if len(keys):
            self.parts.append(np.unique(keys, return_counts=True))
            self.held += len(self.parts[-1][0])
        if self.held > 4 * _HELD:
            self.parts = [self.take()] if self.parts else []
            self.held = len(self.parts[0][0])
        return self.held > 2 * _HELD

    def take(self) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([k for k, _ in self.parts] or [np.zeros(0, np.int64)]), return_inverse=True)
        counts = np.zeros(len(keys), np.int64)
        np.add.at(counts, at, np.concatenate([c for _, c in self.parts] or [np.zeros(0, np.int64)]))
        self.parts, self.held = [], 0
        return keys, counts


def _rows(lang: list[str] | str, phrases: list[bytes], counted: bool, counts: np.ndarray) -> pa.RecordBatch:
    langs = [lang] * len(phrases) if isinstance(lang, str) else lang
    columns = [pa.array(langs, pa.string()), pa.array(phrases, pa.binary()).cast(pa.string()), pa.array([counted] * len(phrases), pa.bool_()), pa.array(counts, pa.int64())]
    return pa.RecordBatch.from_arrays(columns, names=["lang", "phrase", "counted", "n"])


@dataclass
class DoubleArray:
    """A trie in two arrays: child = base[state] + code if check[child] is the state. The first step of a phrase is its language.

    ``accept`` numbers the states where a phrase ends (-1 elsewhere), ``phrases`` has them in that order.
    """

    base: np.ndarray
    check: np.ndarray
    accept: np.ndarray
    words: list[bytes]
    langs: list[str]
    phrases: list[tuple[str, bytes]]
    length: int

    @classmethod
    def build(cls, phrases: list[tuple[str, bytes]], length: int) -> DoubleArray:
        split = [p.split(b" ") for _, p in phrases]
        words = sorted({w for s in split for w in s})
        langs = sorted({lang for lang, _ in phrases})
        number = {w: i for i, w in enumerate(words, 1)}
        place = {lang: i for i, lang in enumerate(langs, 1)}
        steps = np.array([[place[lang], *(number[w] for w in s)] for (lang, _), s in zip(phrases, split, strict=True)], np.int64).reshape(len(phrases), length + 1)
        node, nodes, edges = np.zeros(len(phrases), np.int64), 1, []
        width = max(len(words), len(langs)) + 1
        for depth in range(length + 1):
            step, child = np.unique(node * width + steps[:, depth], return_inverse=True)
            edges.append((step // width, step % width, nodes + np.arange(len(step))))
            node, nodes = nodes + child, nodes + len(step)
        parent, code, child = (np.concatenate(e) for e in zip(*edges, strict=True))
        slots = _slots(parent, code, nodes)
        slot_of = np.zeros(nodes, np.int64)
        slot_of[child] = slots[parent] + code
        size = int(max(slot_of.max(initial=0), slots.max(initial=0))) + len(words) + 2
        base, check, accept = np.zeros(size, np.int32), np.full(size, -1, np.int32), np.full(size, -1, np.int32)
        base[slot_of] = slots
        check[slot_of[child]] = slot_of[parent]
        accept[slot_of[node]] = np.arange(len(phrases))
        return cls(base, check, accept, words, langs, phrases, length)

    def advance(self, states: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Where every state goes with its code; -1 where the trie has no such step."""
        to = self.base[states] + codes
        return np.where((codes > 0) & (self.check[to] == states), to, -1)

    def ends(self, lang: str, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, phrase numbers): where a phrase of the language begins, and which."""
        if lang not in self.langs:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        start = self.advance(np.zeros(1, np.int64), np.array([self.langs.index(lang) + 1]))[0]
        at = np.arange(len(codes))
        states = np.full(len(codes), start)
        for level in range(self.length):
            inside = at + level < len(codes)
            at, states = at[inside], states[inside]
            states = self.advance(states, codes[at + level])
            at, states = at[states >= 0], states[states >= 0]
        return at, self.accept[states]


def _slots(parent: np.ndarray, code: np.ndarray, nodes: int) -> np.ndarray:
    """A base for every node so that no two edges share a slot; slot 0 is the root's own.

    Nodes with many children are fitted one after the other into the first gap
    found; all others try places at random, together, until each has one.
    """
    order = np.argsort(parent, kind="stable")
    parent, code = parent[order], code[order]
    first, degree = np.searchsorted(parent, np.arange(nodes)), np.bincount(parent, minlength=nodes)
    base, rng = np.zeros(nodes, np.int64), np.random.default_rng(1)
    most = int(code.max(initial=0)) + 1
    used = np.zeros(4 * len(code) + 2 * most + 2, bool)
    used[0] = True
    end = 1
    for node in np.argsort(-degree, kind="stable")[: int((degree > 8).sum())]:
        own = code[first[node] : first[node] + degree[node]]
        for _ in range(16):
            tries = rng.integers(0, end) + np.arange(256)
            free = ~used[np.minimum(tries[:, None] + own[None, :], len(used) - 1)].any(axis=1)
            if free.any():
                base[node] = tries[int(free.argmax())]
                break
        else:
            base[node] = end
        top = int(base[node] + own.max()) + 1
        if top + most + 256 > len(used):
            used = np.concatenate([used, np.zeros(len(used) + most + 256, bool)])
        used[base[node] + own] = True
        end = max(end, top)
    left = np.flatnonzero((degree > 0) & (degree <= 8))
    space = max(end, 4 * len(code) + most)
    while len(left):
        if space + most + 1 > len(used):
            used = np.concatenate([used, np.zeros(space + most + 1 - len(used), bool)])
        many = degree[left]
        edge = np.repeat(first[left], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
        owner = np.repeat(np.arange(len(left)), many)
        offset = rng.integers(0, space, len(left))
        slot = offset[owner] + code[edge]
        alone = np.zeros(len(slot), bool)
        alone[np.unique(slot, return_index=True)[1]] = True
        clash = np.bincount(owner, used[slot] | ~alone, minlength=len(left)) > 0
        base[left[~clash]] = offset[~clash]
        used[slot[~clash[owner]]] = True
        left, space = left[clash], space + space // 64
    return base


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: dict[str, Counter] = {}

    def flush() -> Iterator[pa.RecordBatch]:
        for lang, found in counts.items():
            found.pop(_BOUNDARY, None)
            yield _rows(lang, list(found), True, np.fromiter(found.values(), np.int64, len(found)))
        counts.clear()

    for lang, words in _texts(batches):
        counts.setdefault(lang, Counter()).update(words)
        if sum(map(len, counts.values())) > _HELD:
            yield from flush()
    yield from flush()


def _pair_counter(frequent: Callable[[], dict[str, list[bytes]] | None]):
    """Counts of adjacent words, of frequent ones alone where a list of them is given."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = frequent()
        codes: dict[str, Codes] = {}
        keys: dict[str, Keys] = {}

        def flush(lang: str) -> pa.RecordBatch:
            (pair, times), words = keys[lang].take(), codes[lang].words
            phrases = [words[a - 1] + b" " + words[b - 1] for a, b in zip((pair >> 32).tolist(), (pair & 0xFFFFFFFF).tolist(), strict=True)]
            if codes[lang].more:
                del codes[lang]
            return _rows(lang, phrases, False, times)

        for lang, words in _texts(batches):
            if lang not in codes:
                codes[lang] = Codes([], True) if listed is None else Codes(listed.get(lang, []), False)
            found = codes[lang](words)
            both = (found[:-1] > 0) & (found[1:] > 0)
            full = keys.setdefault(lang, Keys()).add((found[:-1][both] << 32) | found[1:][both])
            if full or len(codes[lang].words) > 2 * _HELD and codes[lang].more:
                yield flush(lang)
        for lang in keys:
            if lang in codes:
                yield flush(lang)

    return count


def _phrase_counter(trie: Callable[[], DoubleArray], whole: bool, longer: bool):
    """Counts of the trie's phrases, and of the phrases one word longer that may be frequent.

    With all candidates in the trie (``whole``) a longer phrase counts if both
    its ends are candidates; otherwise any word may follow.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = trie()
        totals = np.zeros(len(own.phrases), np.int64)
        codes, keys = Codes(own.words, not whole), Keys()

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal codes
            pair, times = keys.take()
            which, word = (pair >> 32).tolist(), (pair & 0xFFFFFFFF).tolist()
            phrases = [own.phrases[p][1] + b" " + codes.words[w - 1] for p, w in zip(which, word, strict=True)]
            if phrases:
                yield _rows([own.phrases[p][0] for p in which], phrases, False, times)
            if codes.more:
                codes = Codes(own.words, True)

        for lang, words in _texts(batches):
            found = codes(words)
            at, phrase = own.ends(lang, np.where(found <= len(own.words), found, 0))
            totals += np.bincount(phrase, minlength=len(totals))
            if not longer:
                continue
            follows = at + own.length < len(found)
            if whole:
                starts = np.zeros(len(found) + 1, bool)
                starts[at] = True
                follows &= starts[at + 1]
            at, phrase = at[follows], phrase[follows].astype(np.int64)
            word = found[at + own.length]
            full = keys.add((phrase[word > 0] << 32) | word[word > 0])
            if full or codes.more and len(codes.words) > len(own.words) + _HELD:
                yield from flush()
        yield from flush()
        seen = np.flatnonzero(totals)
        yield _rows([own.phrases[i][0] for i in seen], [own.phrases[i][1] for i in seen], True, totals[seen])

    return count


def _summed(found: DataFrame, least: int) -> DataFrame:
    return found.groupBy("lang", "phrase", "counted").agg(F.sum("n").alias("n")).where(F.col("n") >= least)


def frequent_phrases(texts: DataFrame, frequent: DataFrame, least: int, longest: int, trie_phrases: int, vocabulary: int) -> list[DataFrame]:
    """(lang, phrase, n) of all phrases of 2 words, of 3, and so on, that occur ``least`` times; one table a length.

    ``texts`` has lang and text in UTF-8, ``frequent`` the lang and phrase of the
    frequent words. These are broadcast up to ``vocabulary`` of them; beyond it
    the pairs of all words are counted. Candidates are broadcast in tries of at
    most ``trie_phrases``, each with a pass over the texts.
    """
    context = texts.sparkSession.sparkContext
    listed = None
    if frequent.count() <= vocabulary:
        words: dict[str, list[bytes]] = {}
        for row in frequent.select("lang", "phrase").toLocalIterator():
            words.setdefault(row.lang, []).append(row.phrase.encode())
        listed = {lang: sorted(w) for lang, w in words.items()}
    held = context.broadcast(listed)
    pairs = texts.mapInArrow(_pair_counter(lambda: held.value), _FOUND)
    candidates = stored(_summed(pairs, least).select("lang", "phrase"), "pairs")
    out = []
    for length in range(2, longest + 1):
        rows = candidates.count()
        if not rows:
            break
        tries = -(-rows // trie_phrases)
        # Twice as many parts as are needed keep every one below the bound; equal hashes of different phrases cannot fill one.
        tries = 1 if tries == 1 else 2 * tries
        found = None
        for part in range(tries):
            chosen = candidates.where(F.pmod(F.xxhash64("lang", "phrase"), F.lit(tries)) == part)
            listing = sorted((r.lang, r.phrase.encode()) for r in chosen.toLocalIterator())
            if not listing:
                continue
            trie = context.broadcast(DoubleArray.build(listing, length))
            counted = texts.mapInArrow(_phrase_counter(lambda trie=trie: trie.value, tries == 1, length < longest), _FOUND)
            found = counted if found is None else found.union(counted)
        level = stored(_summed(found, least), f"phrases-{length}")
        out.append(level.where("counted").select("lang", "phrase", "n"))
        candidates = level.where("NOT counted").select("lang", "phrase")
    return out


def _wide(column: str) -> Column:
    return F.col(column).cast("decimal(19,0)")


def collocations(
    documents: DataFrame,
    text: str = "text",
    lang: str = "lang",
    least: int = 100,
    longest: int = 5,
    top: int = 2000,
    absorb: int = 100,
    trie_phrases: int = 400_000,
    vocabulary: int = 1_000_000,
) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): the ``top`` collocations of every language.

    Texts are lower-cased (A-Z), cut into pieces at . , ; : ! ? and line ends,
    and these into words at blanks and tabs. a counts a phrase of 2 to
    ``longest`` words wherever it occurs within a piece, at least ``least``
    times; l and r count the two parts of the cut with the lowest score floor(
    1000 a n / (l r)), the first such cut; n counts all words of the language.
    A phrase inside a longer one with ``absorb`` percent of its count is left
    out. Ties in score go by a, then by phrase in UTF-8 order. A null text is
    empty, a null language ``und``; repeated rows count again; very long texts
    are worked on in parts of whole pieces. An empty table gives no rows; other
    columns are not read.

    A phrase can be frequent only if its words and both its ends are: each
    level's candidates come from places where two candidates of the level before
    overlap. All counts are whole numbers, products decimals of 38 digits.
    """
    prepare(documents.sparkSession)
    rows = documents.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.encode(F.coalesce(F.col(text), F.lit("")), "UTF-8").alias("text"))
    words = stored(rows.mapInArrow(_count_words, _FOUND).groupBy("lang", "phrase").agg(F.sum("n").alias("n")), "words")
    totals = words.groupBy("lang").agg(F.sum("n").alias("total"))
    frequent = words.where(F.col("n") >= least)
    levels = frequent_phrases(rows, frequent, least, longest, trie_phrases, vocabulary)
    phrases = frequent.limit(0)
    for level in levels:
        phrases = phrases.union(level)
    phrases = phrases.withColumn("words", F.split("phrase", " "))

    parts = frequent.select("lang", "phrase", "n").union(phrases.select("lang", "phrase", "n"))
    cuts = phrases.select("lang", "phrase", F.col("n").alias("a"), "words", F.explode(F.sequence(F.lit(1), F.size("words") - 1)).alias("k"))
    first, rest = F.slice("words", 1, F.col("k")), F.slice("words", F.col("k") + 1, F.size("words") - F.col("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(first, " ").alias("first"), F.array_join(rest, " ").alias("rest"))
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("first"), F.col("n").alias("l")), ["lang", "first"])
    cuts = cuts.join(parts.select("lang", F.col("phrase").alias("rest"), F.col("n").alias("r")), ["lang", "rest"]).join(F.broadcast(totals), "lang")
    score = F.call_function("div", _wide("a") * _wide("total") * F.lit(1000), _wide("l") * _wide("r"))
    cuts = cuts.withColumn("cut", F.struct(score.alias("score"), "k", "l", "r"))
    scored = cuts.groupBy("lang", "phrase").agg(F.min("cut").alias("cut"), F.first("a").alias("a"), F.first("total").alias("n"))

    sizes = F.sequence(F.lit(2), F.size("words") - 1)
    longer = phrases.where(F.size("words") > 2).select("lang", "n", "words", F.explode(sizes).alias("size"))
    longer = longer.select("lang", "n", "words", "size", F.explode(F.sequence(F.lit(1), F.size("words") - F.col("size") + 1)).alias("at"))
    longer = longer.select("lang", "n", F.array_join(F.slice("words", F.col("at"), F.col("size")), " ").alias("phrase"))
    longer = longer.groupBy("lang", "phrase").agg(F.max("n").alias("outer"))
    kept = scored.join(longer, ["lang", "phrase"], "left").where("outer IS NULL OR " + f"100 * cast(outer AS decimal(19,0)) < {absorb} * cast(a AS decimal(19,0))")
    per_lang = Window.partitionBy("lang").orderBy(F.col("score").desc(), F.col("a").desc(), "phrase")
    kept = kept.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score").withColumn("rank", F.row_number().over(per_lang))
    return kept.where(F.col("rank") <= top).select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
