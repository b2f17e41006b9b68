"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment of words.

The seeds of a test item are its word n-grams, without those that are far more common in the documents
than the item's others; how many documents hold an n-gram is counted over all of them. A
passage of a document is aligned to an item where seeds of the item meet. How many must meet follows
from the least score: with the scores of `MATCH`, `MISMATCH` and `GAP` each point that a copy loses
breaks at most one seed, so a passage with fewer cannot reach it. This holds for items with more seeds than points may be lost, all kept;
of others one seed must meet. So an edited copy is lost where it shares no seed with an item of some six words or less, and
where the replaced words are those of the rare seeds of an item whose common ones were dropped. Other copies that were
edited, shortened or extended by some words still meet, and the alignment decides. The score is that
of the best local alignment over that of the item with itself. Below the least score an alignment still counts as a
copy of a part if it covers `PART_WORDS` words of the item, holds `PART_SEEDS` of its rare seeds, and reaches
`PART_SCORE` over its own length; so fewer seeds must meet where an item has that many words.

Up to `BLOCK_ITEMS` items of `BLOCK_BYTES` in all are held by every task, with their index; documents are
read in place, twice, and never shuffled. More items are met by joins, with the same results: two scans of the documents count and
meet the seeds of all items, and a third takes out the texts to align, however many items there are. Shuffled are n-grams that may be
seeds, by a filter of bounded size, and texts in which enough seeds of an item meet.

Cases: a null or empty text has no words, matches nothing and, as an item, is matched by nothing. An item of fewer than
`NGRAM` words has one seed, all its words. Items with equal texts match the same documents. Rows with a null id
give results with a null id. A repeated document gives repeated results; a passage that is in a document more than once
counts by its best alignment. Texts of any length are read whole. Empty tables give empty results. Other columns do not matter.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import repeat

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cadastra.llm.columns import Aside
from cadastra.scratch import written

#: Words of a seed.
NGRAM = 3
#: Least share of the item's own score.
THRESHOLD = 0.65
#: The least words of a copied part, its rare seeds, and its score over its own length.
PART_WORDS, PART_SEEDS, PART_SCORE = 13, 4, 0.85
#: A seed that stands in more than this many times the median of its item's seeds is not rare.
COMMON = 8
MATCH, MISMATCH, GAP = 2, -1, -2
#: Items that every task holds, at most, and the bytes of their texts. More are met by joins.
BLOCK_ITEMS = 20_000
BLOCK_BYTES = 4 << 20
#: The most bits of a filter, and those of a chunk of it, as powers of two: 32 MB in chunks of 8 KB.
FILTER_BITS, CHUNK_BITS = 28, 16
#: Words whose hashes, and n-grams that, a task holds at a time; items that are aligned to a text at a time.
REMEMBERED_WORDS, HELD_SEEDS, TEXT_ITEMS = 500_000, 200_000, 200

RESULT = "doc_id string, item_id string, score double, start_char long, end_char long"
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    """Words in lower case, each by itself: lower-casing a text may change its length."""
    return [word.lower() for word in _WORD.findall(text or "")]


class SeedIndex:
    """The items of a block, as word numbers, and their n-grams, as sorted codes."""

    def __init__(self, items: list[tuple[int | str | None, str | None]], threshold: float = THRESHOLD) -> None:
        self.threshold = threshold
        self.vocabulary: dict[str, int] = {}
        self.ids: list[int | str | None] = []
        self.items: list[np.ndarray] = []
        for item_id, text in items:
            if words := words_of(text):
                numbers = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
                self.ids.append(item_id)
                self.items.append(np.array(numbers, np.int64))
        self.base = len(self.vocabulary) + 1
        pairs = [np.unique(self.codes(item if len(item) >= NGRAM else np.pad(item, (0, NGRAM - len(item)))))  for item in self.items]
        self.short = any(len(item) < NGRAM for item in self.items)
        code = np.concatenate(pairs) if pairs else np.zeros(0, np.int64)
        self.owner = np.repeat(np.arange(len(pairs)), [len(p) for p in pairs])
        self._arrange(code)

    def _arrange(self, code: np.ndarray) -> None:
        order = np.argsort(code, kind="stable")
        self.owner = self.owner[order]
        self.seeds, self.first = np.unique(code[order], return_index=True)
        self.last = np.append(self.first[1:], len(order))
        have, lost = np.bincount(self.owner, minlength=len(self.items)), self._lost()
        long = np.array([len(item) >= PART_WORDS for item in self.items], bool)
        self.need = np.where(long, np.minimum(PART_SEEDS, np.maximum(1, have - lost)), np.maximum(1, have - lost))

    def _lost(self) -> np.ndarray:
        """The points, and so the seeds at most, that a copy of each item may lose."""
        return np.array([int((1 - self.threshold) * MATCH * len(item)) for item in self.items], int)

    def codes(self, numbers: np.ndarray) -> np.ndarray:
        """One number for each n-gram in a row of word numbers."""
        count = len(numbers) - NGRAM + 1
        if count <= 0:
            return np.zeros(0, np.int64)
        total = numbers[:count].copy()
        for step in range(1, NGRAM):
            total = total * self.base + numbers[step : step + count]
        return total

    def keep_rare(self, frequency: np.ndarray) -> None:
        """Drop the seeds that are common; frequency: documents that hold each of `seeds`."""
        if not len(self.seeds):
            return
        spread = np.repeat(frequency, self.last - self.first)
        code = np.repeat(self.seeds, self.last - self.first)
        by_item = np.argsort(self.owner, kind="stable")
        limit = np.zeros(len(self.items))
        for at, rows in zip(np.unique(self.owner), np.split(by_item, np.flatnonzero(np.diff(self.owner[by_item])) + 1), strict=True):
            limit[at] = COMMON * max(1.0, float(np.median(spread[rows])))
        kept = spread <= limit[self.owner]
        self.owner = self.owner[kept]
        self._arrange(code[kept])

    def keep_numbered(self, numbers: Iterable[Iterable[int]]) -> None:
        """Keep of each item the distinct seeds with these numbers, in the order in which they first occur in it."""
        kept = []
        for item, chosen in zip(self.items, numbers, strict=True):
            codes = self.codes(np.pad(item, (0, max(0, NGRAM - len(item)))))
            kept.append(codes[np.sort(np.unique(codes, return_index=True)[1])][np.asarray(list(chosen), int)])
        self.owner = np.repeat(np.arange(len(kept)), [len(k) for k in kept])
        self._arrange(np.concatenate(kept) if kept else np.zeros(0, np.int64))

    def numbers(self, words: list[str]) -> np.ndarray:
        found = np.fromiter(map(self.vocabulary.get, words, repeat(0)), np.int64, len(words))
        return np.append(found, [0] * (NGRAM - 1)) if self.short else found

    def hits(self, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(positions, seeds) of all seeds in a document."""
        codes = self.codes(numbers)
        if not len(codes) or not len(self.seeds):
            return np.zeros(0, int), np.zeros(0, int)
        if self.short:  # an item shorter than a seed is followed by anything
            spots, found = [], []
            for size in range(1, NGRAM + 1):
                cut = codes // self.base ** (NGRAM - size) * self.base ** (NGRAM - size)
                at = np.searchsorted(self.seeds, cut).clip(max=len(self.seeds) - 1)
                own = np.flatnonzero((self.seeds[at] == cut) & (cut // self.base ** (NGRAM - 1) > 0))
                spots.append(own)
                found.append(at[own])
            pairs = np.unique(np.stack([np.concatenate(spots), np.concatenate(found)]), axis=1)
            return pairs[0], pairs[1]
        known = np.flatnonzero((numbers[: len(codes)] > 0) & (numbers[NGRAM - 1 :] > 0))
        at = np.searchsorted(self.seeds, codes[known]).clip(max=len(self.seeds) - 1)
        own = self.seeds[at] == codes[known]
        return known[own], at[own]

    def holds_seeds(self, item: int, numbers: np.ndarray) -> bool:
        """Whether a row of words has the rare seeds that a copied part of an item must hold."""
        seeds = np.unique(self.hits(numbers)[1])
        return sum(item in self.owner[self.first[s] : self.last[s]] for s in seeds) >= PART_SEEDS

    def candidates(self, numbers: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """(item, start, end): stretches of words where enough seeds of an item meet."""
        spot, seed = self.hits(numbers)
        if not len(spot):
            return
        count = self.last[seed] - self.first[seed]
        row = np.repeat(np.arange(len(spot)), count)
        owner = self.owner[np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + np.repeat(self.first[seed], count)]
        order = np.lexsort((spot[row], owner))
        row, owner = row[order], owner[order]
        for part in np.split(np.arange(len(row)), np.flatnonzero(np.diff(owner)) + 1):
            item = int(owner[part[0]])
            if len(part) < self.need[item]:
                continue
            yield from self._stretches(item, spot[row[part]], seed[row[part]])

    def _stretches(self, item: int, spots: np.ndarray, seeds: np.ndarray) -> Iterator[tuple[int, int, int]]:
        length = len(self.items[item])
        lost = int((1 - self.threshold) * MATCH * length)
        reach = length + lost // -GAP
        held: dict[int, int] = {}
        first, stretch = 0, None
        for last in range(len(spots)):
            held[seeds[last]] = held.get(seeds[last], 0) + 1
            while spots[last] - spots[first] > reach:
                held[seeds[first]] -= 1
                if not held[seeds[first]]:
                    del held[seeds[first]]
                first += 1
            if len(held) >= self.need[item]:
                start, end = max(0, int(spots[last]) - reach - length), int(spots[first]) + reach + length
                if stretch and start <= stretch[1]:
                    stretch = (stretch[0], max(stretch[1], end))
                else:
                    if stretch:
                        yield item, *stretch
                    stretch = (start, end)
        if stretch:
            yield item, *stretch


def _best(item: np.ndarray, stretch: np.ndarray) -> tuple[int, int]:
    """(score, end) of the best local alignment of two rows of word numbers."""
    slope = GAP * np.arange(len(stretch) + 1)
    above = np.zeros(len(stretch) + 1, np.int64)
    best, end = 0, 0
    for number in item:
        row = np.zeros(len(stretch) + 1, np.int64)
        np.maximum(above[:-1] + np.where(stretch == number, MATCH, MISMATCH), above[1:] + GAP, out=row[1:])
        np.maximum(row, 0, out=row)
        row = np.maximum.accumulate(row - slope) + slope
        at = int(row.argmax())
        if row[at] > best:
            best, end = int(row[at]), at
        above = row
    return best, end


def align(item: np.ndarray, stretch: np.ndarray) -> tuple[float, int, int]:
    """(score, start, end) of the best local alignment; 1.0 is the item itself, whole."""
    best, end = _best(item, stretch)
    if not best:
        return 0.0, 0, 0
    _, back = _best(item[::-1], stretch[:end][::-1])
    return best / (MATCH * len(item)), end - back, end


def _is_part(item: int, part: np.ndarray, score: float, index: SeedIndex) -> bool:
    """Whether an aligned row of words copies a long part of an item."""
    body = index.items[item]
    if score * len(body) < PART_SCORE * PART_WORDS or not index.holds_seeds(item, part):
        return False
    _, low, high = align(part, body)
    return high - low >= PART_WORDS and score * len(body) >= PART_SCORE * max(high - low, len(part))


def match_text(text: str | None, index: SeedIndex) -> list[tuple[int | str | None, float, int, int]]:
    """(item id, score, start, end in characters) of each item that a text holds a copy of."""
    numbers = index.numbers(words_of(text))
    best: dict[int, tuple[float, int, int]] = {}
    for item, start, end in index.candidates(numbers):
        score, low, high = align(index.items[item], numbers[start:end])
        if score <= best.get(item, (0.0,))[0]:
            continue
        if score >= index.threshold or _is_part(item, numbers[start + low : start + high], score, index):
            best[item] = (score, start + low, start + high)
    if not best:
        return []
    spans = [m.span() for m in _WORD.finditer(text or "")]
    return [(index.ids[i], s, spans[low][0], spans[min(high, len(spans)) - 1][1]) for i, (s, low, high) in sorted(best.items())]


def _one_block(items: DataFrame, item_id: str, text: str) -> list[tuple] | None:
    """(id, text) of all items, if they are few and small enough for every task to hold."""
    count, size = items.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length(text)), F.lit(0))).first()
    if count > BLOCK_ITEMS or size > BLOCK_BYTES:
        return None
    return sorted((tuple(r) for r in items.select(F.col(item_id).cast("long"), text).collect()), key=str)


def _frequencies(docs: DataFrame, index: SeedIndex, text: str) -> np.ndarray:
    """How many documents hold each seed."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(len(index.seeds), np.int64)
        for batch in batches:
            for value in batch["text"]:
                total[np.unique(index.hits(index.numbers(words_of(value)))[1])] += 1
        held = np.flatnonzero(total)
        yield pd.DataFrame({"seed": held, "n": total[held]})

    counted = docs.select(F.col(text).alias("text")).mapInPandas(count, "seed long, n long")
    total = np.zeros(len(index.seeds), np.int64)
    for seed, n in counted.groupBy("seed").agg(F.sum("n")).collect():  # one row a seed of the block, at most
        total[seed] = n
    return total


class _WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __missing__(self, word: str) -> int:
        if len(self) >= REMEMBERED_WORDS:
            self.clear()
        number = self[word] = xxhash.xxh64_intdigest(word)
        return number


def _gram_hashes(words: list[str], size: int, hashes: _WordHashes) -> np.ndarray:
    """One hash for each run of `size` words."""
    count = len(words) - size + 1
    if count <= 0:
        return np.zeros(0, np.uint64)
    numbers = np.fromiter(map(hashes.__getitem__, words), np.uint64, len(words))
    total = numbers[:count].copy()
    for step in range(1, size):
        total = (total ^ (total >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + numbers[step : step + count]
    return (total ^ (total >> np.uint64(32))) * np.uint64(0x9E3779B97F4A7C15)


class HashFilter:
    """Which hashes may be known: one bit each, at most `FILTER_BITS` to the power of two of them.

    What it lets through by mistake is dropped by the join that follows.
    """

    def __init__(self, hashes: DataFrame) -> None:
        """`hashes`: one column, `hash`. The driver sees the bits, in chunks, never the hashes."""
        self.bits = min(FILTER_BITS, max(CHUNK_BITS, (16 * hashes.count()).bit_length()))
        spot = F.shiftrightunsigned("hash", 64 - self.bits)
        spots = hashes.select(F.shiftright(spot, CHUNK_BITS).alias("chunk"), spot.bitwiseAND((1 << CHUNK_BITS) - 1).alias("at"))

        def pack(rows: pd.DataFrame) -> pd.DataFrame:
            held = np.zeros(1 << CHUNK_BITS, np.uint8)
            held[rows["at"]] = 1
            return pd.DataFrame({"chunk": rows["chunk"][:1], "held": [np.packbits(held, bitorder="little").tobytes()]})

        packed = spots.distinct().groupBy("chunk").applyInPandas(pack, "chunk long, held binary")
        self.held = np.zeros(1 << (self.bits - 3), np.uint8)
        width = 1 << (CHUNK_BITS - 3)
        for chunk, held in packed.collect():
            self.held[chunk * width : (chunk + 1) * width] = np.frombuffer(bytes(held), np.uint8)

    def may_hold(self, hashes: np.ndarray) -> np.ndarray:
        spot = hashes >> np.uint64(64 - self.bits)
        return (self.held[spot >> np.uint64(3)] >> (spot & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1

    def grams(self, text: str | None, sizes: list[int], hashes: _WordHashes) -> set[str]:
        """The distinct word n-grams of a text that may be known."""
        words, found = words_of(text), set()
        for size in sizes:
            for at in np.flatnonzero(self.may_hold(_gram_hashes(words, size, hashes))):
                found.add(" ".join(words[at : at + size]))
        return found

    def passes(self, number: Column) -> Column:
        @F.pandas_udf("boolean")
        def passes(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            for batch in batches:
                yield pd.Series(self.may_hold(batch.to_numpy(np.int64).view(np.uint64)), dtype=bool)

        return passes(number)


def _item_seeds(bodies: DataFrame, threshold: float) -> DataFrame:
    """(key, seed, number, size, hash, words, lost) of the distinct seeds of each item, numbered in their order in it."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for batch in batches:
            rows = []
            for key, value in zip(batch["key"], batch["text"], strict=True):
                words = words_of(value)
                if not words:
                    continue
                size = min(NGRAM, len(words))
                lost = int((1 - threshold) * MATCH * len(words))
                grams = (" ".join(words[i : i + size]) for i in range(len(words) - size + 1))
                numbers = _gram_hashes(words, size, hashes).view(np.int64).tolist()
                distinct = dict(zip(grams, numbers, strict=True))
                rows += [(key, seed, i, size, number, len(words), lost) for i, (seed, number) in enumerate(distinct.items())]
            yield pd.DataFrame(rows, columns=["key", "seed", "number", "size", "hash", "words", "lost"])

    return bodies.mapInPandas(cut, "key string, seed string, number int, size int, hash long, words long, lost long")


def _seed_counts(docs: DataFrame, known: HashFilter, sizes: list[int]) -> DataFrame:
    """(seed, n): how many documents hold each n-gram that may be a seed."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes, total = _WordHashes(), Counter()
        for batch in batches:
            for value in batch["text"]:
                total.update(known.grams(value, sizes, hashes))
                if len(total) >= HELD_SEEDS:
                    yield pd.DataFrame(total.items(), columns=["seed", "n"])
                    total.clear()
        yield pd.DataFrame(total.items(), columns=["seed", "n"])

    return docs.select("text").mapInPandas(count, "seed string, n long").groupBy("seed").agg(F.sum("n").alias("n"))


def _rare_seeds(seeds: DataFrame, counts: DataFrame) -> DataFrame:
    """The seeds that are not common, with how many of them must meet; as `SeedIndex.keep_rare` finds them."""
    counted = written(seeds.join(counts, "seed", "left").fillna(0, ["n"]), "counted")
    usual = counted.groupBy("key").agg(F.median("n").alias("usual"))
    kept = counted.join(usual, "key").where(F.col("n") <= COMMON * F.greatest(F.lit(1.0), "usual"))
    kept = written(kept.drop("n", "usual"), "kept")
    least = F.greatest(F.lit(1), F.col("have") - F.col("lost"))
    need = F.when(F.col("words") >= PART_WORDS, F.least(F.lit(PART_SEEDS), least)).otherwise(least)
    return kept.join(kept.groupBy("key").agg(F.count(F.lit(1)).alias("have")), "key").withColumn("need", need)


def _seed_hits(docs: DataFrame, known: HashFilter, sizes: list[int]) -> DataFrame:
    """(digest, seed): the n-grams of each text that may be rare seeds."""

    def hit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hashes = _WordHashes()
        for batch in batches:
            texts = batch.drop_duplicates("digest")
            digests, seeds = [], []
            for digest, value in zip(texts["digest"], texts["text"], strict=True):
                found = known.grams(value, sizes, hashes)
                digests += [digest] * len(found)
                seeds += found
                if len(seeds) >= HELD_SEEDS:
                    yield pd.DataFrame({"digest": digests, "seed": seeds})
                    digests, seeds = [], []
            yield pd.DataFrame({"digest": digests, "seed": seeds}, dtype=object)

    return docs.select("digest", "text").mapInPandas(hit, "digest string, seed string")


def _aligned(docs: DataFrame, bodies: DataFrame, threshold: float) -> DataFrame:
    """(doc_id, digest, key, score, start_char, end_char) for `docs` of (doc_id, text, digest) and items of any number.

    Equal texts have one digest. Seeds of all items are counted in one scan of the documents and met in
    a second one; what is shuffled are n-grams that are seeds. A third scan takes out the texts in which enough seeds of an
    item meet, with those items, to align them.
    """
    seeds = written(_item_seeds(bodies, threshold), "seeds")
    sizes = sorted(r["size"] for r in seeds.select("size").distinct().collect())  # NGRAM at most
    counts = _seed_counts(docs, HashFilter(seeds.select("hash").distinct()), sizes)
    rare = written(_rare_seeds(seeds, counts), "rare")
    hits = _seed_hits(docs, HashFilter(rare.select("hash").distinct()), sizes)
    met = hits.join(rare.select("seed", "key", "number", "need"), "seed").groupBy("digest", "key")
    met = met.agg(F.count_distinct("number").alias("held"), F.max("need").alias("need")).where("held >= need")
    place = F.row_number().over(Window.partitionBy("digest").orderBy("key"))
    met = met.select("digest", "key", F.floor((place - 1) / TEXT_ITEMS).alias("part"))
    chosen = bodies.join(rare.groupBy("key").agg(F.sort_array(F.collect_list("number")).alias("numbers")), "key")
    parts = met.join(chosen, "key").groupBy("digest", "part").agg(F.collect_list(F.struct("key", "text", "numbers")).alias("items"))
    columns = [F.col(f"items.{c}").alias(f"item_{c}") for c in ("key", "text", "numbers")]
    parts = written(parts.select("digest", "part", *columns), "candidates")
    texts = HashFilter(parts.select(F.xxhash64("digest").alias("hash")).distinct())

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, index = None, None
        for batch in batches:
            rows = []
            for row in batch.itertuples(index=False):
                if (row.digest, row.part) != last:
                    last = row.digest, row.part
                    index = SeedIndex(list(zip(row.item_key, row.item_text, strict=True)), threshold)
                    index.keep_numbered(row.item_numbers)
                rows += [(row.doc_id, row.digest, *match) for match in match_text(row.text, index)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in found.split(", ")])

    found = "doc_id string, digest string, key string, score double, start_char long, end_char long"
    whole = docs.where(F.col("digest").isNotNull()).where(texts.passes(F.xxhash64("digest")))
    return whole.join(parts, "digest").mapInPandas(search, found)


def _bodies(items: DataFrame, item_id: str, text: str) -> tuple[DataFrame, DataFrame]:
    """((item_id, key) of each item, (key, text) of each text)."""
    keyed = items.where(F.col(text).isNotNull()).select(F.col(item_id).cast("long").alias("item_id"), F.col(text).alias("text"), F.sha2(text, 256).alias("key"))
    return keyed.select("item_id", "key"), written(keyed.groupBy("key").agg(F.first("text").alias("text")), "bodies")


def find_copies(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text: str = "text", doc_id: str = "doc_id", item_id: str = "item_id"
) -> DataFrame:
    """(doc_id, item_id, score, start_char, end_char) for each document and each item that it holds a copy of."""
    # Ids as text: a column of numbers with nulls would pass through Python as floats.
    named = docs.select(F.col(doc_id).cast("long").cast("string").alias("doc_id"), F.col(text).alias("text"))
    held = _one_block(items, item_id, text)
    if held is None:
        ids, bodies = _bodies(items, item_id, text)
        found = _aligned(named.withColumn("digest", F.sha2("text", 256)), bodies, threshold).join(ids, "key")
        return found.select(F.col("doc_id").cast("long"), "item_id", "score", "start_char", "end_char")
    index = SeedIndex([(None if i is None else str(i), body) for i, body in held], threshold)
    index.keep_rare(_frequencies(docs, index, text))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(doc, *match) for doc, value in zip(batch["doc_id"], batch["text"], strict=True) for match in match_text(value, index)]
            yield pd.DataFrame(rows, columns=[c.split()[0] for c in RESULT.split(", ")])

    return named.mapInPandas(search, RESULT).withColumns({c: F.col(c).cast("long") for c in ("doc_id", "item_id")})


def _holds(text: Column, index: SeedIndex) -> Column:
    @F.pandas_udf("boolean")
    def holds(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series([bool(match_text(value, index)) for value in batch], dtype=bool)

    return holds(text)


def remove_copies(
    docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD, text: str = "text", item_id: str = "item_id"
) -> DataFrame:
    """`docs` without the rows whose text holds a copy of an item; all else stays as it is."""
    held = _one_block(items, item_id, text)
    if held is not None:
        index = SeedIndex(held, threshold)
        index.keep_rare(_frequencies(docs, index, text))
        return docs.where(~_holds(F.col(text), index))
    aside = Aside(docs)
    digest = F.sha2(aside[text], 256)
    texts = aside.frame.select(F.lit(None).cast("string").alias("doc_id"), aside[text].alias("text"), digest.alias("digest"))
    copies = written(_aligned(texts, _bodies(items, item_id, text)[1], threshold).select("digest").distinct(), "copies")
    # Texts that are surely no copy are not shuffled.
    suspect = HashFilter(copies.select(F.xxhash64("digest").alias("hash"))).passes(F.xxhash64(F.coalesce(digest, F.lit(""))))
    marked = aside.frame.withColumns({"digest": digest, "suspect": suspect})
    clean = marked.where("NOT suspect").drop("digest", "suspect")
    kept = clean.union(marked.where("suspect").drop("suspect").join(copies, "digest", "left_anti").drop("digest"))
    return aside.back(kept, [])


