"""Documents that share most of their five-word shingles, by parity sketches.

A document's shingles are dealt by hash into as many parts as it has shingles, about; a part's word is the XOR
of the hashes in it. Words make a sketch: one shingle changes one word, so the number of words in which two
sketches differ is at most the symmetric difference of the sets. For a Jaccard of 0.75 that difference is at
most a seventh of both sizes together, hence linked documents agree in all words but so many, and (pigeonhole)
among any so many plus one of the words of each, taken in one common order, there is a word they share.

- Sizes fall into bands with one number of parts; a document is sketched for its own band and, if a larger
  partner can lie there, for the next one. A pair meets in the band of its larger side.
- The common order puts words that few documents have first (a census counts them), so that passages which
  many documents share lead to no candidates unless they make up most of a document. Words that one document
  has need not be sent at all.
- Where a small set has too few parts for the argument to hold, its shingles serve as words of their own.
- Documents with one set of shingles are one row from the start. Of the documents with a word in common each
  is first verified against one of them; what is then in one component needs no more pairs. Only words
  whose documents still lie in several components give pairs among those components, so that no link is lost.
  There the join itself compares parity sketches of single bits, two for each shingle: pairs too far apart
  for a link never leave it, and others leave it once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.census import Ledger, blocks_of, census, ordered, picked
from quarry.llm.components import components
from quarry.llm.storage import removed, saved
from quarry.llm.wordscan import BLANKS, Words, batches, byte_table, distinct, mix, texts_of

SIZE = 5
TABLE = byte_table(BLANKS)
STAR_ROUNDS = 2
LISTED_KEYS = 512
KEYS_PER_BYTE = 0.15
MOST_BITS = 16
LIMITS = np.array([int((2 ** (2 * k + 1)) ** 0.5) for k in range(31)], dtype=np.int64)  # largest size of band k


def sets(texts: list[bytes], size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingle hashes and their texts, ordered by text, then hash."""
    values, docs = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo, hi in batches([len(t) for t in texts]):
        v, d = distinct(*Words(texts[lo:hi], TABLE).shingles(size))
        values.append(v)
        docs.append(d + lo)
    return np.concatenate(values), np.concatenate(docs)


def difference(total: np.ndarray) -> np.ndarray:
    """Largest symmetric difference of linked sets whose sizes add up to `total` or less."""
    below = [total - k for k in range(7)]
    return np.max([s - 2 * -(-3 * s // 7) for s in below], axis=0)


class Sketches:
    """Words of all sketches of a list of texts: key, sketch number; and per sketch its text and prefix length."""

    def __init__(self, values: np.ndarray, doc: np.ndarray, n_texts: int):
        n = np.bincount(doc, minlength=n_texts)
        begin = np.cumsum(n) - n
        own = np.flatnonzero(n > 0)
        band = np.searchsorted(LIMITS, n[own], "left")
        most = 4 * n[own] // 3
        wide = most > LIMITS[band]
        self.doc = np.concatenate([own, own[wide]])
        self.band = np.concatenate([band, band[wide] + 1])
        partner = np.concatenate([np.minimum(most, LIMITS[band]), most[wide]])
        self.allowed = difference(n[self.doc] + partner)
        sizes = n[self.doc]
        sketch = np.repeat(np.arange(len(self.doc)), sizes)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + begin[self.doc][sketch]
        token, bits = values[at], self.band[sketch].astype(np.uint64)
        part = np.where(bits > 0, token >> (np.uint64(64) - np.maximum(bits, np.uint64(1))), np.uint64(0))
        first = np.flatnonzero(np.concatenate([[True], (part[1:] != part[:-1]) | (sketch[1:] != sketch[:-1])])) if len(token) else np.zeros(0, np.int64)
        word = np.bitwise_xor.reduceat(token, first) if len(first) else token
        place = mix((bits[first] << np.uint64(40)) + part[first] + np.uint64(1))
        self.key, self.sketch = mix(word ^ place), sketch[first]
        parts = np.bincount(self.sketch, minlength=len(self.doc))
        self.kind = np.zeros(len(self.doc), dtype=np.int64)
        few = np.flatnonzero(parts - self.allowed < 1)  # these also go by single shingles
        if len(few):
            chosen = np.isin(sketch, few)
            number = np.searchsorted(few, sketch[chosen]) + len(self.doc)
            self.key = np.concatenate([self.key, mix(token[chosen] ^ mix((bits[chosen] << np.uint64(40)) + np.uint64(1 << 39)))])
            self.sketch = np.concatenate([self.sketch, number])
            self.doc = np.concatenate([self.doc, self.doc[few]])
            self.allowed = np.concatenate([self.allowed, self.allowed[few]])
            self.band = np.concatenate([self.band, self.band[few]])
            self.kind = np.concatenate([self.kind, np.ones(len(few), dtype=np.int64)])

    def prefixes(self, count: np.ndarray) -> tuple[np.ndarray, ...]:
        """Keys to meet by, their texts, ranks, bands and kinds: the rarest words of each sketch, but for those nobody else has."""
        order = np.lexsort((self.key, count, self.sketch))
        sketch = self.sketch[order]
        begin = np.searchsorted(sketch, np.arange(len(self.doc)))
        rank = np.arange(len(sketch)) - begin[sketch]
        chosen = order[(rank <= self.allowed[sketch]) & (count[order] >= 2)]
        place = np.empty(len(order), dtype=np.int64)
        place[order] = rank
        own = self.sketch[chosen]
        return self.key[chosen], self.doc[own], place[chosen], self.band[own], self.kind[own]


def parity(tokens: np.ndarray, band: int) -> np.ndarray:
    """One bit for about half a shingle: the parity of the hashes that fall on it, as 64-bit words."""
    bits = 1 << min(max(band + 1, 6), MOST_BITS)
    odd = np.bincount((tokens & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def words_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    sketches = Sketches(*sets(texts), len(texts))
    return sketches.key, sketches.doc[sketches.sketch]


def profiles(tables):
    """Per row: size and two hashes of its set."""
    for batch in tables:
        texts = texts_of(batch.column("text"))
        values, doc = sets(texts)
        n = np.bincount(doc, minlength=len(texts))
        out = []
        for salt in (1, 2):
            sums = np.zeros(len(texts), dtype=np.uint64)
            np.add.at(sums, doc, mix(values ^ np.uint64(salt)))
            out.append(mix(sums + n.astype(np.uint64)).view(np.int64))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(out[0]), pa.array(out[1])], ["doc_id", "n_shingles", "h1", "h2"])


def candidates(table, answer, buckets: int):
    """Documents of a block that share a word of their prefix with others: keys, and the set to verify with."""
    ids, texts = ordered(table)
    keep = np.flatnonzero(picked(ids, answer))
    ids, texts = ids[keep], [texts[i] for i in keep]
    values, doc = sets(texts)
    sketches = Sketches(values, doc, len(texts))
    count = Ledger(sketches.key, sketches.doc[sketches.sketch], buckets).told(answer)
    keys, of, rank, band, kind = sketches.prefixes(count)
    order = np.argsort(of, kind="stable")
    keys, of, rank, band, kind = (x[order] for x in (keys, of, rank, band, kind))
    some = np.unique(of)
    a, b = np.searchsorted(of, some), np.searchsorted(of, some, "right")
    c, d = np.searchsorted(doc, some), np.searchsorted(doc, some, "right")
    lists = lambda v, lo, hi: pa.array([v[i:j] for i, j in zip(lo, hi)], pa.list_(pa.int64()))
    own = np.searchsorted(LIMITS, d - c, "left")
    bits = [[parity(values[i:j], k + up) for i, j, k in zip(c, d, own)] for up in (0, 1)]
    return pa.table(
        {
            "doc_id": pa.array(ids[some], pa.int64()),
            "n": pa.array(d - c, pa.int64()),
            "keys": lists(keys.view(np.int64), a, b),
            "ranks": lists(rank, a, b),
            "sorts": lists(band - np.repeat(own, b - a) + 2 * kind, a, b),
            "bits": pa.array(bits[0], pa.list_(pa.int64())),
            "bits_up": pa.array(bits[1], pa.list_(pa.int64())),
            "tokens": lists(values.view(np.int64), c, d),
        }
    )


FOUND = "doc_id long, n long, keys array<long>, ranks array<long>, sorts array<long>, bits array<long>, bits_up array<long>, tokens array<long>"


def may_link(n: str, rank: str, other_n: str, other_rank: str) -> Column:
    """Sizes allow a link, and the word stands early enough in both orders for a difference these sizes allow.

    Of linked sets some shared word has a rank of at most the difference in both sketches, so others need not lead to the pair.
    """
    a, b = F.col(n), F.col(other_n)
    early = F.floor((a + b) / 7) >= F.greatest(rank, other_rank)
    return (4 * a >= 3 * b) & (4 * b >= 3 * a) & early


def near(a: str, b: str, most: Column) -> Column:
    """The Hamming distance of two parity sketches, which the symmetric difference is never below, is small enough."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: F.bit_count(x.bitwiseXOR(y))), F.lit(0), lambda t, x: t + x) <= most


def linked(pairs: DataFrame, found: DataFrame) -> DataFrame:
    """Pairs (a, b) whose sets have a Jaccard of 0.75 or more."""
    side = lambda x: found.select(F.col("doc_id").alias(x), F.col("n").alias(f"n_{x}"), F.col("tokens").alias(f"t_{x}"))
    both = pairs.join(side("b"), "b").join(side("a"), "a")
    both = both.filter((4 * F.col("n_a") >= 3 * F.col("n_b")) & (4 * F.col("n_b") >= 3 * F.col("n_a")))
    common = F.size(F.array_intersect("t_a", "t_b"))
    return both.select("a", "b", F.col("n_a"), F.col("n_b"), common.alias("common")).filter("100 * common >= 75 * (n_a + n_b - common)").select("a", "b")


def links_of(found: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """Links among distinct sets that suffice for the components, and the tables to remove once they are known."""
    each = found.select("doc_id", "n", F.explode(F.arrays_zip("keys", "ranks", "sorts")).alias("x"))
    keys = saved(each.select("doc_id", "n", F.col("x.keys").alias("key"), F.col("x.ranks").alias("rank"), F.col("x.sorts").alias("sort")), "keys")
    label = keys.select(F.col("doc_id").alias("node"), F.col("doc_id").alias("component")).limit(0)
    links = tested = None
    spent = [keys]
    for turn in range(STAR_ROUNDS + 1):
        own = keys if turn == 0 else keys.join(label, keys.doc_id == label.node, "left").select("doc_id", "n", "key", "rank", "sort", F.coalesce("component", "doc_id").alias("component"))
        if turn:
            open_ = own.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).filter("low < high").select("key")
            own = saved(own.join(open_, "key"), "open")
            spent.append(own)
        if turn < STAR_ROUNDS:
            # the document in which the word stands first, so that has the fewest rarer ones, is most like the others
            # in a later round another one, by hash
            first = F.col("rank") if turn == 0 else F.xxhash64("doc_id", F.lit(turn))
            lead = own.groupBy("key").agg(F.min(F.struct(first.alias("first"), "doc_id", "n", "rank")).alias("l"))
            lead = lead.select("key", F.col("l.doc_id").alias("lead"), F.col("l.n").alias("lead_n"), F.col("l.rank").alias("lead_rank"))
            pairs = own.join(lead, "key").filter("doc_id <> lead").filter(may_link("n", "rank", "lead_n", "lead_rank"))
            if turn:
                heads = label.select(F.col("node").alias("lead"), F.col("component").alias("of_lead"))
                pairs = pairs.join(heads, "lead", "left").filter(F.col("component") != F.coalesce("of_lead", "lead"))
            pairs = pairs.select(F.least("lead", "doc_id").alias("a"), F.greatest("lead", "doc_id").alias("b")).distinct()
        else:
            sketched = own.join(found.select("doc_id", "bits", "bits_up"), "doc_id")
            sketched = sketched.select("doc_id", "n", "key", "rank", "sort", "component", F.when(F.col("sort") % 2 == 0, F.col("bits")).otherwise(F.col("bits_up")).alias("bits"))
            # of the words of one sort a pair leaves the join with the first in common order, which has the lowest
            # rank on both sides; very long lists stay out, distinct() does for them
            lists = own.groupBy("doc_id", "sort").agg(F.sort_array(F.collect_list(F.struct("rank", "key")))["key"].alias("all"))
            sketched = sketched.join(lists.filter(F.size("all") <= LISTED_KEYS), ["doc_id", "sort"], "left")
            one, two = sketched.alias("one"), sketched.alias("two")
            fits = (F.col("one.key") == F.col("two.key")) & (F.col("one.component") != F.col("two.component")) & (F.col("one.doc_id") < F.col("two.doc_id"))
            fits &= may_link("one.n", "one.rank", "two.n", "two.rank") & near("one.bits", "two.bits", F.floor((F.col("one.n") + F.col("two.n")) / 7))
            fits &= F.coalesce(F.get(F.array_intersect("one.all", "two.all"), F.lit(0)) == F.col("one.key"), F.lit(True))
            pairs = one.join(two, fits).select(F.col("one.doc_id").alias("a"), F.col("two.doc_id").alias("b")).distinct()
        if tested is not None:
            pairs = pairs.join(tested, ["a", "b"], "left_anti")
        pairs = saved(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        new = saved(linked(pairs, found), "links")
        links = new if links is None else links.unionByName(new)
        spent += [pairs, new]
        if turn < STAR_ROUNDS:
            label = components(links)
            spent.append(label)
    return links, spent


def joined(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id.

    A text without words has no shingle and is linked with nothing; null counts as such. With fewer than
    five words the whole sequence is the one shingle. Documents with equal sets are linked; repeated rows give
    repeated results (rows that differ under one doc_id are told apart by their sets only, the first text in
    order standing for the doc_id). A row without doc_id takes the component of a document with the same set, else
    null, and links no others. An empty table gives an empty result. doc_id is an integer; only it and text are read.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    rows = saved(docs.mapInArrow(profiles, "doc_id long, n_shingles long, h1 long, h2 long"), "profiles")
    classes = rows.filter("n_shingles > 0 and doc_id is not null").groupBy("n_shingles", "h1", "h2").agg(F.min("doc_id").alias("first"))
    classes = saved(classes, "classes")
    dealt, blocks, n_bytes = blocks_of(docs.filter("doc_id is not null"))
    chosen = classes.select(F.pmod(F.xxhash64(F.col("first")), F.lit(blocks)).cast("int").alias("block"), F.col("first").alias("chosen"))
    answers, buckets = census(dealt, int(n_bytes * KEYS_PER_BYTE) + 1, words_of, chosen)
    both = answers.unionByName(chosen, allowMissingColumns=True)
    found = dealt.groupBy("block").cogroup(both.groupBy("block")).applyInArrow(
        lambda table, answer: candidates(table, answer, buckets), FOUND
    )
    found = saved(found, "candidates")
    links, spent = links_of(found)
    label = components(links)
    removed(found, *spent)
    known = classes.join(label, classes["first"] == label.node, "left").select("n_shingles", "h1", "h2", F.coalesce("component", "first").alias("component_id"))
    return rows.join(known, ["n_shingles", "h1", "h2"], "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
