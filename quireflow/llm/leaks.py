"""Evaluation items whose text stands, whole or in part, in documents.

Texts are compared by their letters and digits alone. An item of n characters leaks
where a connected passage of s characters of it, s at least n / 2, stands in a document
with at most ``ERROR_RATE * s`` edits. By the q-gram lemma such a passage keeps at least
``s - q + 1 - q * e`` of its q-grams under e edits, on diagonals at most e apart. So
shared q-grams are counted in overlapping diagonal bands, bands below the least of these
bounds over all s are dropped, and a banded alignment decides the rest exactly.

Not all q-grams need be counted: with those alone that stand in few items (rare) the
lemma holds with the number of rare q-grams of the passage in place of ``s - q + 1``.
An item whose bound would then be low is counted with q-grams that are less rare, at
last with all, whose bound is one at least. So the choice saves work and drops no case.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .lookalikes import PLAIN

Q = 6
#: Items in which a q-gram may stand to be rare: the first level that leaves every half of the item ``ENOUGH`` counts; edits a character.
RARE, ENOUGH, ERROR_RATE = (4, 8, 16, 32, 64, 1 << 60), 30, 0.07
#: Characters of items that are broadcast at once; more items are searched in several passes.
ITEM_CHARS = 8_000_000
BLOCK = 400_000
SEP = 2
N_CODES = 0x110000
FILTER_BITS = 24


class _Solid:
    """Code -> folded code of a letter or digit, 0 for all else; filled for the codes that occur."""

    def __init__(self) -> None:
        self.to, self.known = np.zeros(N_CODES, np.uint32), np.zeros(N_CODES, bool)
        self.known[SEP] = True
        self.to[SEP] = SEP
        self.known[0x4E00:0xA000] = True
        self.to[0x4E00:0xA000] = np.arange(0x4E00, 0xA000)

    def __call__(self, codes: np.ndarray) -> np.ndarray:
        new = codes[~self.known[codes]]
        for code in np.unique(new):
            plain = "" if 0xD800 <= code < 0xE000 else (PLAIN[int(code)] or "")
            kept = [c for c in plain.lower() if c.isalnum()]
            self.to[code] = ord(kept[0]) if kept else 0
            self.known[code] = True
        return self.to[codes]


SOLID = _Solid()


def _hashes(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """64-bit hashes of the q-grams that begin at each place."""
    n = len(codes) - q + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.zeros(n, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(q):
            h *= np.uint64(0x100000001B3)
            h += codes[k : k + n]
        h *= np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
    return h


def solid_codes(text: str) -> np.ndarray:
    codes = SOLID(np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32))
    return codes[codes > SEP]


@dataclass
class ItemIndex:
    """Items by q-gram. ``gram`` is sorted; equal entries are neighbours."""

    ids: list
    codes: list[np.ndarray]
    gram: np.ndarray
    item: np.ndarray
    place: np.ndarray
    bound: np.ndarray
    width: np.ndarray
    filter: np.ndarray
    all_grams: list[np.ndarray]
    distinct: np.ndarray
    first: np.ndarray


@lru_cache(4096)
def passages(n: int) -> list[tuple[int, int]]:
    """(s, e): the shortest passage of at least half of ``n`` characters for each number of edits that some passage may have.

    Longer ones with the same edits share more q-grams, so a bound that holds for these holds for all.
    """
    half = (n + 1) // 2
    out = [(half, _budget(half))]
    for e in range(out[0][1] + 1, _budget(n) + 1):
        out.append((int(np.ceil(e / ERROR_RATE - 1e-9)), e))
    return out


def _budget(span: int) -> int:
    return int(ERROR_RATE * span + 1e-9)


def build_index(ids: list, texts: list[str]) -> ItemIndex:
    codes = [solid_codes(t) for t in texts]
    grams = [_hashes(c) for c in codes]
    every = np.concatenate([np.unique(g) for g in grams]) if grams else np.zeros(0, np.uint64)
    distinct, found_in = np.unique(every, return_counts=True)
    gram, item, place = [], [], []
    bound, width = np.ones(len(ids), np.int64), np.ones(len(ids), np.int64)
    for k, g in enumerate(grams):
        n = len(codes[k])
        width[k] = max(2, 2 * _budget(n))
        if not len(g):
            continue
        for level in RARE:
            rare = found_in[np.searchsorted(distinct, g)] <= level
            sums = np.concatenate([[0], np.cumsum(rare)])
            # e edits destroy at most q * e q-grams of a passage
            least = min(int((sums[w:] - sums[:-w]).min()) - Q * e for w, e in ((min(max(1, s - Q + 1), len(g)), e) for s, e in passages(n)))
            if least >= ENOUGH:
                break
        bound[k] = max(1, least)
        gram.append(g[rare])
        item.append(np.full(int(rare.sum()), k))
        place.append(np.flatnonzero(rare))
    gram = np.concatenate(gram) if gram else np.zeros(0, np.uint64)
    order = np.argsort(gram, kind="stable")
    gram = gram[order]
    own, first = np.unique(gram, return_index=True)
    bits = np.zeros(1 << FILTER_BITS, bool)
    bits[(gram >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True
    return ItemIndex(ids, codes, gram, np.concatenate(item)[order] if item else np.zeros(0, np.int64), np.concatenate(place)[order] if place else np.zeros(0, np.int64), bound, width, np.packbits(bits), [np.unique(g) for g in grams], own, np.append(first, len(gram)))


def candidates(h: np.ndarray, doc: np.ndarray, index: ItemIndex, bits: np.ndarray) -> np.ndarray:
    """Rows (text, item, least diagonal, greatest diagonal) of the bands that meet the bound; a diagonal is the place in the text less that in the item."""
    none = np.zeros((0, 4), np.int64)
    at = np.flatnonzero(bits[(h >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
    if not len(at) or not len(index.gram):
        return none
    slot = np.minimum(np.searchsorted(index.distinct, h[at]), len(index.distinct) - 1)
    hit = index.distinct[slot] == h[at]
    at, slot = at[hit], slot[hit]
    if not len(at):
        return none
    lo, n = index.first[slot], index.first[slot + 1] - index.first[slot]
    entry = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    where = np.repeat(at, n)
    item = index.item[entry]
    # first per text and item, without regard to diagonals; memory follows the hits, not the number of items
    pair = item * (int(doc[-1]) + 1) + doc[where]
    if len(index.ids) * (int(doc[-1]) + 1) <= 4_000_000:
        total = np.bincount(pair)[pair]
    else:
        _, inverse, total = np.unique(pair, return_inverse=True, return_counts=True)
        total = total[inverse]
    enough = total >= index.bound[item]
    entry, where, item = entry[enough], where[enough], item[enough]
    if not len(entry):
        return none
    # bands are pairs of neighbouring halves; diagonals are those of the whole block, so texts never share one
    step = index.width[item] // 2
    half = (where - index.place[entry] + len(h)) // step
    key = (item << np.int64(40)) | half
    order = np.argsort(key, kind="stable")
    k, w, d = key[order], where[order], doc[where[order]]
    # a q-gram that stands several times in the item counts once for a place
    fresh = np.concatenate([[True], (k[1:] != k[:-1]) | (w[1:] != w[:-1])])
    first = np.flatnonzero(np.concatenate([[True], (k[1:] != k[:-1]) | (d[1:] != d[:-1])]))
    seen = np.add.reduceat(fresh, first)
    key, text = k[first], d[first].astype(np.int64)
    it = key >> np.int64(40)
    follows = np.concatenate([(key[1:] == key[:-1] + 1) & (text[1:] == text[:-1]), [False]])
    both = seen + np.where(follows, np.concatenate([seen[1:], [0]]), 0)
    good = both >= index.bound[it]
    key, text, it = key[good], text[good], it[good]
    if not len(key):
        return none
    # bands that overlap are one
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1] + 1) | (text[1:] != text[:-1])]))
    last = np.append(first[1:], len(key)) - 1
    mask = np.int64((1 << 40) - 1)
    it, step = it[first], index.width[it[first]] // 2
    return np.stack([text[first], it, (key[first] & mask) * step - len(h), ((key[last] & mask) + 2) * step - 1 - len(h)], axis=1)


def _enough(region: np.ndarray, grams: np.ndarray, n: int) -> bool:
    """The same bound once more, with all q-grams of the item: some stretch as long as a passage with its edits must hold enough of them."""
    if not len(region) or not len(grams):
        return False
    at = np.minimum(np.searchsorted(grams, region), len(grams) - 1)
    hits = np.concatenate([[0], np.cumsum(grams[at] == region)])
    for s, e in passages(n):
        w, least = min(s + e, len(region)), s - Q + 1 - Q * e
        if hits[-1] >= least and (hits[w:] - hits[: len(hits) - w]).max() >= least:
            return True
    return False


def aligned(item: np.ndarray, text: np.ndarray, least: int, greatest: int) -> bool:
    """Whether a passage of at least half of ``item`` stands in ``text`` within its edits, on the diagonals from ``least`` to ``greatest``.

    Exact dynamic programming over the band, one layer for each number of edits: the
    value of a cell is the longest stretch of the item that an alignment which ends there
    spans with that many edits. Within a layer runs of equal characters extend the
    stretches along the diagonals, in steps of powers of two.
    """
    n, width = len(item), greatest - least + 1
    half, most = (n + 1) // 2, _budget(n)
    a, b = max(0, least), min(len(text), n + greatest)
    if b <= a:
        return False
    padded = np.zeros(n + width, np.uint32)
    padded[a - least : b - least] = text[a:b]
    # one row for each diagonal
    same = np.lib.stride_tricks.sliding_window_view(padded, n)[:width] == item
    kind = np.int16 if n < 8_000 else np.int32
    # equal characters up to each cell, by doubling; and for each power of two the gain of as many, where they stand before the cell
    span, size, gains = same.astype(kind), 1, []
    while size < n and (full := span == size).any():
        gains.append(size)
        longer = span.copy()
        longer[:, size:] += np.where(full[:, size:], span[:, :-size], kind(0))
        span, size = longer, 2 * size
    if not _possible(span, n):
        return False
    gains = [(g, np.where(span[:, g:] >= g, kind(g), kind(-2 * n))) for g in gains]
    longest: list[int] = []
    for e in range(most + 1):
        if e:
            base = span.copy()
            more = span[:, :-1] + kind(1)
            np.maximum(base[:, 1:], more, out=base[:, 1:])  # another character
            np.maximum(base[:-1, 1:], more[1:], out=base[:-1, 1:])  # one of the item is missing
            np.maximum(base[1:], span[:-1], out=base[1:])  # one more in the text
            np.maximum(base[:, 0], 1, out=base[:, 0])
            for g, gain in gains:
                np.maximum(base[:, g:], base[:, :-g] + gain, out=base[:, g:])
            span = base
        longest.append(int(span.max()))
        if longest[-1] >= max(half, int(np.ceil(e / ERROR_RATE - 1e-9))):
            return True
        if not _reachable(longest, half, most):
            return False
    return False


def _possible(span: np.ndarray, n: int) -> bool:
    """The lemma once more, within the band and for short q-grams, of which an edit destroys fewer."""
    for q in (2, 3, 4):
        hits = np.concatenate([[0], np.cumsum((span[:, q - 1 :] >= q).any(axis=0))])
        if not any((hits[w:] - hits[: len(hits) - w]).max() >= w - q * e for w, e in ((s - q + 1, e) for s, e in passages(n)) if w > 0):
            return False
    return True


def _reachable(longest: list[int], half: int, most: int) -> bool:
    """Whether more edits may still give a passage: one with e + f + 1 edits is one with e, an edit, and one with f."""
    bound = list(longest)
    for f in range(len(longest), most + 1):
        bound.append(min(longest[i] + 1 + bound[f - i - 1] for i in range(min(len(longest), f))))
        if bound[f] >= max(half, int(np.ceil(f / ERROR_RATE - 1e-9))):
            return True
    return False


def _pieces(texts: list[str], overlap: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(codes, number of the text of each code): blocks of whole texts, each ended by SEP; a huge text comes in pieces that share ``overlap`` characters."""
    block, docs, size = [], [], 0
    end = np.array([SEP], np.uint32)
    for k, t in enumerate(texts):
        codes = np.concatenate([solid_codes(t[i : i + BLOCK]) for i in range(0, len(t), BLOCK)] or [end[:0]])
        step = max(BLOCK, overlap)
        for i in range(0, max(1, len(codes)), step):
            part = codes[i : i + step + overlap]
            if size and size + len(part) > BLOCK:
                yield np.concatenate(block), np.repeat(np.array(docs), [len(x) for x in block])
                block, docs, size = [], [], 0
            block.append(np.concatenate([part, end]))
            docs.append(k)
            size += len(part)
    if block:
        yield np.concatenate(block), np.repeat(np.array(docs), [len(x) for x in block])


def leaks_in(texts: list[str], index: ItemIndex, bits: np.ndarray) -> list[tuple[int, int]]:
    """(number of the text, number of the item) of all leaks."""
    longest = max((len(c) for c in index.codes), default=0)
    found: set[tuple[int, int]] = set()
    for codes, doc in _pieces(texts, longest + _budget(longest) + Q):
        ends = np.flatnonzero(codes == SEP)
        part = np.zeros(len(codes), np.int64)
        part[ends[:-1] + 1] = 1
        part = np.cumsum(part)
        starts = np.concatenate([[0], ends[:-1] + 1])
        h = _hashes(codes)
        if not len(h):
            continue
        for p, k, least, greatest in candidates(h, part, index, bits).tolist():
            d = int(doc[starts[p]])
            if (d, k) in found:
                continue
            item = index.codes[k]
            # edits may lead the passage out of the band of its q-grams by as many diagonals
            e, a, b = _budget(len(item)), int(starts[p]), int(ends[p])
            least, greatest = least - e, greatest + e
            lo, hi = max(a, least), min(b, len(item) + greatest)
            if _enough(h[lo : max(lo, hi - Q + 1)], index.all_grams[k], len(item)) and aligned(item, codes[a:b], least - a, greatest - a):
                found.add((d, k))
    return sorted(found)


def find_leaks(docs: DataFrame, items: DataFrame, doc_key: str = "doc_id", text: str = "text", item_key: str = "item_id", item_text: str = "item_text", item_chars: int = ITEM_CHARS) -> DataFrame:
    """Distinct (``doc_key``, ``item_key``): every document with the items it contains.

    The items are broadcast in parts of at most ``item_chars`` characters, so the size of
    what is sent is bounded however many items there are; each part is one pass over the
    documents, which are neither shuffled nor joined.

    Defined cases: null or empty texts and items have no row, nor has an item of fewer
    than 12 letters and digits; repeated rows count once; texts are searched whole;
    copies of a document are cases of their own; empty tables give an empty result.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(doc_key).alias("doc"), F.col(text).alias("text")).filter(F.col("text") != "")
    items = items.select(F.col(item_key).alias("item"), F.col(item_text).alias("text")).dropna().distinct()
    kinds = f"doc {docs.schema['doc'].dataType.simpleString()}, item {items.schema['item'].dataType.simpleString()}"
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-size // item_chars))
    out = None
    for part in range(parts):
        rows = items.filter(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == part).orderBy("item", "text").collect()
        rows = [r for r in rows if len(solid_codes(r.text)) >= 12]
        sent = spark.sparkContext.broadcast(build_index([r.item for r in rows], [r.text for r in rows]))

        def search(batches: Iterator[pd.DataFrame], sent=sent) -> Iterator[pd.DataFrame]:
            index = sent.value
            bits = np.unpackbits(index.filter).view(bool)
            for batch in batches:
                for a, b in _blocks(batch.text.str.len().to_numpy()):
                    part = batch.iloc[a:b]
                    found = leaks_in(part.text.tolist(), index, bits)
                    if found:
                        ids = part.doc.to_numpy()
                        yield pd.DataFrame({"doc": [ids[d] for d, _ in found], "item": [index.ids[k] for _, k in found]})

        one = docs.mapInPandas(search, kinds)
        out = one if out is None else out.union(one)
    return out.distinct().withColumnsRenamed({"doc": doc_key, "item": item_key})


def _blocks(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    start = size = 0
    for i, n in enumerate(sizes):
        if size and size + n > BLOCK:
            yield start, i
            start, size = i, 0
        size += n
    if start < len(sizes):
        yield start, len(sizes)
