"""N-gram Jaccard join: exact links between texts whose sets of word shingles have a Jaccard similarity of at least a threshold.

Texts with equal sets form one class first. Each class puts its set into a prefix of shingles that any partner above the
threshold must share (a global order puts shingles found in many texts last, so prefixes hold rare ones). The classes that
share a prefix shingle make a tile. Linked sets share more than one shingle of their prefixes, and how many is known from their sizes. So tiles of
up to SMALL classes are written out as pairs, and pairs are counted: one that shares too few, and no larger tile, has no link.
Larger tiles are named by their least class, which makes one of those that a passage gives rise to, and cut into size bands: only sizes that the threshold allows meet.
Inside a tile, hashed bitmaps of 1 to 2 bits a shingle bound the overlap from above: each bit set in one bitmap alone stands for a shingle that
the other set lacks. Pairs that the bound lets through are intersected exactly, as sorted arrays.

Pairs are never expanded within groups of copies. First the counted pairs are tried, and every class of a larger tile against a few
partners there (the least classes of its tiles, those that share most prefix shingles, and neighbours); then only pairs of a tile whose classes
are still in different components, the likeliest of each class first, then of each class and component, then all that are left. So no link that could join two components is left out, and a
group of g copies costs a few times g tests.

A shingle that more than HOT classes may have is dealt into several buckets by class, and its tile is compared in blocks, so none is one task's.
Defined results: null and empty texts have an empty set, no links, and are their own component; repeated rows and equal
texts share a class; columns other than id and text are ignored. A row with a null id keeps it; it is in the
component of texts equal to it, but a text that only such rows have has no links. Shingles are compared by 64-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from atlasmill.llm.components import components
from atlasmill.llm.shingles import mix, shingle_sets
from atlasmill.llm.workspace import Workspace, partitions, table

#: A shingle is common if about one text in so many has it; the list is at most mean set size x COMMON long, whatever the input.
COMMON = 1000
#: Members of a tile that one task compares at a time, prefix entries that one task sorts, and those of one shingle that it takes.
BLOCK, BUCKET, HOT = 2048, 1_000_000, 200_000
#: Tiles of up to so many members are written out as pairs.
SMALL = 8
#: A block, or two, of which bitmaps let through more pairs than so many times its members is compared again, by short shingles besides.
VAGUE = 4
#: Least classes that a member of larger tiles is tried with first, and neighbours, in the order of class keys, that are alike to the same one.
TRIES, RING = 4, 3


def prefix_length(n: int, percent: int) -> int:
    """Of an ordered set of n, so many first elements meet those of any set with the similarity."""
    return n - -(-n * percent // 100) + 1 if n else 0


def least_shared(n: np.ndarray, m: np.ndarray, percent: int) -> np.ndarray:
    """Of the prefixes of linked sets of sizes n and m, so many shingles are in both.

    A set lacks n - shared of its shingles in the other one. All of the prefix that ends first but those are in the other prefix.
    """
    shared = -(-percent * (n + m) // (100 + percent))
    first, other = ((x - -(-x * percent // 100) + 1) - (x - shared) for x in (n, m))
    return np.minimum(first, other)


def bitmap(s: np.ndarray) -> bytes:
    bits = 1 << max(6, (len(s) - 1).bit_length())
    flags = np.zeros(bits, np.uint8)
    flags[(s & np.uint64(bits - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def fold(b: np.ndarray, size: int) -> np.ndarray:
    """Rows of bitmaps, folded to size bytes each."""
    return np.bitwise_or.reduce(b.reshape(len(b), -1, size), axis=1) if b.shape[1] > size else b


def overlap_bound(n: np.ndarray, m: int, b: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Most that sets of sizes n (bitmaps in the rows of b) can share with one of size m (bitmap c); all of one width."""
    apart = np.bitwise_count((b ^ c).view(np.uint64)).sum(axis=1, dtype=np.int64)
    return (n + m - apart) // 2


def enough(shared, n, m, percent: int):
    """percent of the union at least: 100 * shared >= percent * (n + m - shared)."""
    return (100 + percent) * shared >= percent * (n + m)


def set_key(s: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)


def _describe(k: int, common: int):
    """Per text its class, size and bitmap; per partition the shingles that about one of common classes has, with counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        held, size = [], 0
        keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)

        def settle():
            nonlocal keys, counts, held, size
            k2, inverse = np.unique(np.concatenate([keys, *held]), return_inverse=True)
            c2 = np.bincount(inverse, weights=np.concatenate([counts, np.ones(size, np.int64)]), minlength=len(k2)).astype(np.int64)
            least = max(1, len(seen) // (4 * common)) if len(k2) > 1_000_000 else 0
            keys, counts, held, size = k2[c2 > least], c2[c2 > least], [], 0

        for batch in batches:
            out = {"id": batch.column("id"), "ent": [], "n": [], "bits": []}
            for s in shingle_sets(batch.column("text").to_pylist(), k):
                key = set_key(s)
                out["ent"].append(key)
                out["n"].append(len(s))
                out["bits"].append(bitmap(s) if len(s) else b"")
                if len(s) and key not in seen:
                    seen.add(key)
                    held.append(s)
                    size += len(s)
                    if size > 500_000:
                        settle()
            yield pa.record_batch({"kind": pa.array([0] * len(batch), pa.int32()), "id": pa.array(out["id"], pa.int64()), "ent": pa.array(out["ent"], pa.int64()), "n": pa.array(out["n"], pa.int64()), "bits": pa.array(out["bits"], pa.binary())})
        settle()
        often = counts >= max(2, len(seen) // common)
        m = int(often.sum())
        yield pa.record_batch({"kind": pa.array([1] * m, pa.int32()), "id": pa.nulls(m, pa.int64()), "ent": pa.array(keys[often].view(np.int64)), "n": pa.array(counts[often]), "bits": pa.nulls(m, pa.binary())})

    return run


def _prefixes(k: int, percent: int, common, buckets: int, hot: int):
    """Entries (shingle, class, size) of every class's prefix, as columns in one blob a bucket; each class once a partition.

    Of a shingle's hash, 32 bits beside the bucket suffice here: a collision only makes a tile larger. Of shingles that more than hot
    classes may have, entries go to several buckets; their sizes are negative.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        late, counts = (np.frombuffer(x, t) for x, t in zip(common.value, (np.uint64, np.int64), strict=True))
        ways = -(-counts // hot)
        seen: set[int] = set()
        held: list[tuple[np.ndarray, int, int]] = []
        size = 0

        def emit():
            h = np.concatenate([x[0] for x in held])
            each = [len(x[0]) for x in held]
            ent, n = np.repeat(np.array([x[1] for x in held], np.int64), each), np.repeat(np.array([x[2] for x in held], np.int32), each)
            to = (h % np.uint64(buckets)).astype(np.int64)
            if len(ways) and ways.max() > 1:
                at = np.minimum(np.searchsorted(late, h), len(late) - 1)
                wide = (late[at] == h) & (ways[at] > 1)
                to[wide] = (to[wide] + (mix(ent[wide].view(np.uint64)) % ways[at[wide]].astype(np.uint64)).astype(np.int64)) % buckets
                n[wide] *= -1
            order = np.argsort(to, kind="stable")
            h, ent, n, to = h[order], ent[order], n[order], to[order]
            cut = np.flatnonzero(np.diff(to, prepend=-1))
            ends = [*cut[1:], len(to)]
            return pa.record_batch({"bucket": pa.array(to[cut], pa.int64())} | {c: pa.array([x[a:b].tobytes() for a, b in zip(cut, ends, strict=True)], pa.binary()) for c, x in (("h", (h >> np.uint64(32)).astype(np.uint32)), ("ent", ent), ("n", n))})

        for batch in batches:
            for s in shingle_sets(batch.column("text").to_pylist(), k):
                if len(s) and (key := set_key(s)) not in seen:
                    seen.add(key)
                    p = prefix_length(len(s), percent)
                    if len(late):
                        at = np.minimum(np.searchsorted(late, s), len(late) - 1)
                        often = late[at] == s
                        s = np.concatenate([s[~often], s[often]]) if often.any() else s
                    held.append((s[:p], key, len(s)))
                    size += p
            if size >= 500_000:
                yield emit()
                held, size = [], 0
        if held:
            yield emit()

    return run


#: Kinds of rows of tiles: a pair of small tiles (a, b), a member of a larger one (tile, class). n: the member's size; votes: shared prefix
#: shingles, a member's with its tile's least class; need: those that a link needs, or NEVER.
PAIR, MEMBER = 0, 1
NEVER = 1 << 40
NUMBERS = ("a", "b", "n", "votes", "need")
TILES = "kind int, " + ", ".join(f"{c} long" for c in NUMBERS)
BLOBS = "kind int, sub long, " + ", ".join(f"{c} binary" for c in NUMBERS)


def _tiles(percent: int, subs: int):
    """Of a bucket's entries the rows of its tiles, as blobs dealt by a and b."""

    def dealt(kind: int, *cols: np.ndarray) -> pa.Table:
        sub = (mix(cols[0].view(np.uint64) ^ mix(cols[1].view(np.uint64))) % np.uint64(subs)).astype(np.int64)
        order = np.argsort(sub, kind="stable")
        sub = sub[order]
        cut = np.flatnonzero(np.diff(sub, prepend=-1))
        ends = np.append(cut[1:], len(sub))[: len(cut)]
        blobs = {c: pa.array([x[s:e].tobytes() for s, e in zip(cut, ends, strict=True)], pa.binary()) for c, x in zip(NUMBERS, (x[order] for x in cols), strict=True)}
        return pa.table({"kind": pa.array([kind] * len(cut), pa.int32()), "sub": pa.array(sub[cut], pa.int64())} | blobs)

    def run(group: pa.Table) -> pa.Table:
        h, ent, n = (np.concatenate([np.frombuffer(x, t) for x in group.column(c).to_pylist()]) for c, t in (("h", np.uint32), ("ent", np.int64), ("n", np.int32)))
        order = np.lexsort((ent, np.abs(n), h))
        h, ent, n = h[order], ent[order], n[order].astype(np.int64)
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (ent[1:] != ent[:-1])
        h, ent, n, wide = h[new], ent[new], np.abs(n[new]), n[new] < 0
        first = np.flatnonzero(np.diff(h, prepend=~h[:1]))
        length = np.diff(np.append(first, len(h)))
        small = (length <= SMALL) & ~wide[first]
        a, b = [], []
        for m in range(2, SMALL + 1):
            at = first[small & (length == m)]
            for i in range(m):
                for j in range(i + 1, m):  # by size
                    fits = n[at + i] * 100 >= n[at + j] * percent
                    a.append(at[fits] + i)
                    b.append(at[fits] + j)
        a, b = np.concatenate(a), np.concatenate(b)
        need = least_shared(n[a], n[b], percent)
        both, at, votes = np.unique(np.stack([np.minimum(ent[a], ent[b]), np.maximum(ent[a], ent[b])]), axis=1, return_index=True, return_counts=True)
        pairs = dealt(PAIR, *both, np.zeros(len(at), np.int64), votes.astype(np.int64), need[at])
        rows: list[tuple] = []
        for s, m in zip(first[~small], length[~small], strict=True):
            e, size = ent[s : s + m], n[s : s + m]
            if not wide[s]:
                near = size[:-1] * 100 >= size[1:] * percent  # who has no neighbour in size has no partner here
                keep = np.append(near, False) | np.append(False, near)
                e, size = e[keep], size[keep]
            if len(e):
                c = int(e.argmin())
                rows.append((np.full(len(e), e[c]), e, size, np.full(len(e), size[c])))
            if wide[s]:  # parts of the tile in other buckets have the same name
                rows.append((np.full(len(e), mix(h[s : s + 1].astype(np.uint64)).view(np.int64)[0]), e, size, np.zeros(len(e), np.int64)))
        tile, e, size, least = (np.concatenate(x) for x in zip(*rows, strict=True)) if rows else [np.empty(0, np.int64)] * 4
        both, at, votes = np.unique(np.stack([tile, e]), axis=1, return_index=True, return_counts=True)
        size, least = size[at], least[at]
        fits = np.minimum(size, least) * 100 >= np.maximum(size, least) * percent
        need = np.where(fits & (both[0] != both[1]), least_shared(size, least, percent), NEVER)
        return pa.concat_tables([pairs, dealt(MEMBER, *both, size, votes.astype(np.int64), need)])

    return run


def _merge(group: pa.Table) -> pa.Table:
    """Rows of equal (a, b) as one, with all their votes. Pairs that share too few shingles are left out; one less will do, as two of a pair may have equal 32 bits."""
    a, b, n, votes, need = (np.concatenate([np.frombuffer(x, np.int64) for x in group.column(c).to_pylist()]) for c in NUMBERS)
    kind = group.column("kind")[0].as_py()
    both, at, inverse = np.unique(np.stack([a, b]), axis=1, return_index=True, return_inverse=True)
    votes = np.bincount(inverse.ravel(), weights=votes).astype(np.int64)
    cols = [*both, n[at], votes, need[at]]
    if kind == PAIR:
        cols = [x[votes >= need[at] - 1] for x in cols]
    return pa.table({"kind": pa.array([kind] * len(cols[0]), pa.int32())} | {c: pa.array(x, pa.int64()) for c, x in zip(NUMBERS, cols, strict=True)})


def _ring(percent: int):
    """Pairs of neighbours of a tile in a partition's order, of sizes that may be linked."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            tile, ent, n = (t.column(c).to_numpy() for c in ("a", "b", "n"))
            a, b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
            for gap in range(1, RING + 1):
                fits = (tile[:-gap] == tile[gap:]) & (np.minimum(n[:-gap], n[gap:]) * 100 >= percent * np.maximum(n[:-gap], n[gap:]))
                a.append(ent[:-gap][fits])
                b.append(ent[gap:][fits])
            yield pa.record_batch({"a": pa.array(np.concatenate(a)), "b": pa.array(np.concatenate(b))})

    return run


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each row's partition, and its place among the rows of its tile there."""
    from pyspark import TaskContext

    part, tile, n = TaskContext.get().partitionId(), None, 0
    for t in batches:
        key = t.column("tile").to_numpy()
        cut = np.flatnonzero(np.diff(key)) + 1
        place = [np.empty(0, np.int64)]
        for a, b in zip([0, *cut], [*cut, len(key)], strict=True):
            if a < b:
                if key[a] != tile:
                    tile, n = key[a], 0
                place.append(n + np.arange(b - a))
                n += b - a
        yield pa.RecordBatch.from_arrays([*t.columns, pa.array([part] * len(key), pa.int32()), pa.array(np.concatenate(place), pa.int64())], names=[*t.schema.names, "part", "place"])


def short(s: np.ndarray) -> np.ndarray:
    """Of each shingle 16 bits that bitmaps of up to 2**16 bits do not use alone; equal ones stay, so the length is the set's size."""
    return (s >> np.uint64(48)).astype(np.uint16)


def _pairs(ent: np.ndarray, n: np.ndarray, comp: np.ndarray, blk: np.ndarray, bits: list[bytes], shorts: list[bytes | None], percent: int) -> Iterator[pa.RecordBatch]:
    """Of one block of a tile or two, by size: pairs of different components that sizes and bitmaps allow, a batch at a time.

    Where all have short shingles, those of a set that the other has too bound the overlap of what the bitmaps let through.
    """
    told = all(x is not None for x in shorts)
    if told:
        listed = np.frombuffer(b"".join(shorts), np.uint16)
        ends = np.concatenate(([0], np.cumsum([len(x) // 2 for x in shorts])))
        has = np.zeros(1 << 16, bool)
    rows = [np.frombuffer(x, np.uint8) for x in bits]
    width = np.array([len(r) for r in rows])
    two = len(np.unique(blk)) > 1
    starts = {int(w): (int(np.argmax(width == w)), np.stack([r for r in rows if len(r) == w])) for w in np.unique(width)}
    a, b, bounds, size = [], [], [], 0

    def take():
        x, y = np.concatenate(a), np.concatenate(b)
        return pa.record_batch({"a": np.minimum(x, y), "b": np.maximum(x, y), "bound": np.concatenate(bounds), "told": np.full(len(x), told)})

    for i in range(len(n)):
        end = int(np.searchsorted(n, int(n[i]) * 100 // percent, "right"))
        for w, (at, stack) in starts.items():  # widths follow sizes, so each is one run
            lo, hi = max(i + 1, at), min(end, at + len(stack))
            if lo < hi:
                far = np.flatnonzero((comp[lo:hi] != comp[i]) & ((blk[lo:hi] != blk[i]) | (not two)))
                if len(far):
                    least = int(min(w, width[i]))
                    bound = overlap_bound(n[lo:hi][far], int(n[i]), fold(stack[lo - at : hi - at][far], least), fold(rows[i][None, :], least)[0])
                    good = enough(bound, n[lo:hi][far], int(n[i]), percent)
                    if told and good.any():
                        own = listed[ends[i] : ends[i + 1]]
                        has[own] = True
                        x, y = lo + far[good][0], lo + far[good][-1] + 1
                        both = np.add.reduceat(has[listed[ends[x] : ends[y]]], ends[x:y] - ends[x], dtype=np.int64)
                        bound[good] = np.minimum(bound[good], both[lo + far[good] - x])
                        has[own] = False
                        good = enough(bound, n[lo:hi][far], int(n[i]), percent)
                    if good.any():
                        ok = lo + far[good]
                        a.append(np.full(len(ok), ent[i]))
                        b.append(ent[ok])
                        bounds.append((1000 * bound[good]) // (n[ok] + n[i]))
                        size += len(ok)
                        if size > 50_000:
                            yield take()
                            a, b, bounds, size = [], [], [], 0
    if size:
        yield take()


def _within(percent: int, vague: int | None):
    """Rows of a partition, sorted by (tile, p, q, n): one block or pair of blocks after the other.

    Pairs (a, b, bound, told). With vague, of blocks that give more than vague times their members only their names (tile, p, q).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []

        def close():
            if not held:
                return
            ent, n, comp, blk = (np.concatenate([h[c] for h in held]) for c in range(4))
            kept, size = [], 0
            for out in _pairs(ent, n, comp, blk, [x for h in held for x in h[4]], [x for h in held for x in h[5]], percent):
                kept.append(out)
                size += len(out)
                if vague is None:
                    yield from (named(x, None) for x in kept)
                    kept = []
                elif size > vague * len(ent):
                    yield named(None, key)
                    return
            yield from (named(x, None) for x in kept)

        def named(out, block):
            m = len(out) if out is not None else 1
            pairs = out.columns if out is not None else [pa.nulls(1, t) for t in (pa.int64(), pa.int64(), pa.int64(), pa.bool_())]
            at = [pa.array([x], pa.int64()) for x in block] if block else [pa.nulls(m, pa.int64())] * 3
            return pa.RecordBatch.from_arrays([*pairs, *at], names=["a", "b", "bound", "told", "tile", "p", "q"])

        for t in batches:
            k = [t.column(c).to_numpy() for c in ("tile", "p", "q")]
            cols = [t.column(c).to_numpy().copy() for c in ("ent", "n", "comp", "blk")]
            bits, shorts = t.column("bits").to_pylist(), t.column("short").to_pylist()
            edge = np.zeros(len(bits), bool)
            for x in k:
                edge[1:] |= x[1:] != x[:-1]
            cut = np.flatnonzero(edge)
            for s, e in zip([0, *cut], [*cut, len(bits)], strict=True):
                if s < e:
                    now = tuple(int(x[s]) for x in k)
                    if now != key:
                        yield from close()
                        key, held = now, []
                    held.append((*[c[s:e] for c in cols], bits[s:e], shorts[s:e]))
        yield from close()

    return run


def _allowed(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for t in batches:
            keep = []
            for n, m, x, y in zip(t.column("n").to_pylist(), t.column("m").to_pylist(), t.column("x").to_pylist(), t.column("y").to_pylist(), strict=True):
                size = min(len(x), len(y))
                p, q = (fold(np.frombuffer(z, np.uint8)[None, :], size) for z in (x, y))
                keep.append(bool(enough(overlap_bound(np.array([n]), m, p, q[0])[0], n, m, percent)))
            t = t.filter(pa.array(keep, pa.bool_()))
            yield pa.record_batch({"a": t.column("a"), "b": t.column("b")})

    return run


ASKED_BITS = 22


def _ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A Bloom filter of fixed size of the ids of a partition."""
    flags = np.zeros(1 << ASKED_BITS, np.uint8)
    for t in batches:
        flags[(mix(t.column("rep").to_numpy().astype(np.uint64)) >> np.uint64(64 - ASKED_BITS)).astype(np.int64)] = 1
    yield pa.record_batch({"f": pa.array([np.packbits(flags).tobytes()], pa.binary())})


def _sets(k: int, asked, brief: bool):
    """(class, set) of the texts whose ids may be asked for; the join with those that are follows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flags, seen = np.unpackbits(np.frombuffer(asked.value, np.uint8)), set()
        for t in batches:
            t = t.filter(t.column("id").is_valid())
            keep = flags[(mix(t.column("id").to_numpy().astype(np.uint64)) >> np.uint64(64 - ASKED_BITS)).astype(np.int64)] == 1
            ent, sets = [], []
            for s in shingle_sets(t.column("text").filter(pa.array(keep)).to_pylist(), k):
                if (key := set_key(s)) not in seen:
                    seen.add(key)
                    ent.append(key)
                    sets.append((short(s) if brief else s).tobytes())
            yield pa.record_batch({"ent": pa.array(ent, pa.int64()), "s": pa.array(sets, pa.binary())})

    return run


def _intersect(percent: int, brief: bool):
    """Rows of a partition, sorted by (group, salt, part): a centre's set comes right before those tried against it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, centre, has = None, np.empty(0, np.uint64), np.zeros(1 << 16, bool)
        for t in batches:
            u, v, bound = [], [], []
            for a, salt, part, b, s in zip(*(t.column(c).to_pylist() for c in ("a", "salt", "part", "b", "s")), strict=True):
                s = np.frombuffer(s, np.uint16 if brief else np.uint64)
                if part == 0:
                    has[centre if brief and at else slice(0)] = False
                    at, centre = (a, salt), s
                    has[centre if brief else slice(0)] = True
                elif at == (a, salt):
                    if brief:
                        shared = int(has[s].sum())
                    else:
                        both = np.concatenate([centre, s])
                        both.sort()
                        shared = int((both[1:] == both[:-1]).sum())
                    if enough(shared, len(centre), len(s), percent):
                        u.append(a)
                        v.append(b)
                        bound.append(1000 * shared // (len(centre) + len(s)))
            yield pa.record_batch({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64()), "bound": pa.array(bound, pa.int64())})

    return run


#: Partners that a centre's set is sent with at a time.
PARTNERS = 32


def _asked_sets(ws: Workspace, ents: DataFrame, texts: DataFrame, reps: DataFrame, k: int, brief: bool) -> DataFrame:
    """(ent, s) of the classes asked for, and others, made from the text of one row, or once a partition where rows repeat: whole hashes, or 16 bits of each."""
    need = ws.save(ents.select("ent").distinct().join(reps.where("rep IS NOT NULL").select("ent", "rep"), "ent"), "asked")
    asked = np.zeros(1 << (ASKED_BITS - 3), np.uint8)
    for (x,) in need.select("rep").coalesce(8).mapInArrow(_ask, "f binary").collect():
        asked |= np.frombuffer(x, np.uint8)
    return texts.mapInArrow(_sets(k, texts.sparkSession.sparkContext.broadcast(asked.tobytes()), brief), "ent long, s binary")


def _links(ws: Workspace, pairs: DataFrame, texts: DataFrame, reps: DataFrame, k: int, percent: int, brief: bool = False) -> DataFrame:
    """Pairs (u, v, bound) of classes whose sets, or with brief the short forms of them, meet the threshold."""
    salts = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).alias("salts"))
    roles = pairs.select("a", "b").join(salts, "a").select("a", F.pmod(F.xxhash64("b"), "salts").cast("int").alias("salt"), F.lit(1).alias("part"), "b")
    roles = ws.save(roles.unionByName(roles.select("a", "salt").distinct().select("a", "salt", F.lit(0).alias("part"), F.col("a").alias("b"))), "roles")
    sets = _asked_sets(ws, roles.select(F.col("b").alias("ent")), texts, reps, k, brief)
    given = roles.join(sets, roles.b == sets.ent).select("a", "salt", "part", "b", "s")
    return given.repartition("a", "salt").sortWithinPartitions("a", "salt", "part").mapInArrow(_intersect(percent, brief), "u long, v long, bound long")


def _classes(ws: Workspace, docs: DataFrame, id_col: str, text_col: str, k: int, percent: int, common: int, hot: int) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Texts; their rows by class; classes; and the classes that meet in tiles."""
    spark = ws.spark
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    told = ws.save(texts.mapInArrow(_describe(k, common), "kind int, id long, ent long, n long, bits binary"), "described")
    rows = told.where("kind = 0")
    size = rows.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.floor(F.col("n") * (100 - percent) / 100) + 1), F.lit(0)).alias("entries")).first()
    often = told.where("kind = 1").groupBy("ent").agg(F.sum("n").alias("n")).where(F.col("n") >= max(2, size["rows"] // common)).select("ent", "n")
    listed = np.array([tuple(r) for r in often.toLocalIterator()], np.int64).reshape(-1, 2)
    listed = listed[np.argsort(listed[:, 0].copy().view(np.uint64))]
    often = spark.sparkContext.broadcast((listed[:, 0].tobytes(), listed[:, 1].tobytes()))
    classes = ws.save(rows.groupBy("ent").agg(F.min("id").alias("rep"), F.first("n").alias("n"), F.first("bits").alias("bits")), "classes")
    buckets = max(partitions(spark), math.ceil(size["entries"] / BUCKET))
    blobs = texts.mapInArrow(_prefixes(k, percent, often, buckets, hot), "bucket long, h binary, ent binary, n binary")
    tiles = blobs.groupBy("bucket").applyInArrow(_tiles(percent, buckets), BLOBS)
    met = ws.save(tiles.groupBy("kind", "sub").applyInArrow(_merge, TILES), "tiles")
    return texts, rows, classes, met


def _fit(ws: Workspace, pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs that bitmaps allow. pairs: written."""
    ents = ws.save(pairs.select(F.explode(F.array("a", "b")).alias("ent")).distinct(), "ents")
    few = ws.save(classes.join(ents, "ent", "left_semi").select("ent", "n", "bits"), "few")
    left, right = (few.select(F.col("ent").alias(e), F.col("n").alias(n), F.col("bits").alias(x)) for e, n, x in (("a", "n", "x"), ("b", "m", "y")))
    return ws.save(pairs.join(left, "a").join(right, "b").mapInArrow(_allowed(percent), "a long, b long"), "fit")


def _close(ws: Workspace, met: DataFrame, classes: DataFrame, texts: DataFrame, roots: DataFrame, k: int, percent: int, block: int) -> DataFrame:
    """Pairs (a, b, bound) of classes of different components in larger tiles that sizes, bitmaps and short shingles allow."""
    member = met.where(F.col("kind") == MEMBER).select(F.col("a").alias("tile"), F.col("b").alias("ent"), "n").join(roots, F.col("ent") == roots.node, "left").select("tile", "ent", "n", F.coalesce("root", "ent").alias("comp"))
    member = ws.save(member, "members")
    apart = member.groupBy("tile").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count("*").alias("members")).where("lo < hi").select("tile", "members")
    member = ws.save(member.join(apart, "tile"), "apart")
    # a member of a large tile meets its own block and the others, two at a time, but for blocks of one component and of sizes too far apart
    small = member.where(F.col("members") <= block).select("tile", F.lit(0).cast("long").alias("p"), F.lit(0).cast("long").alias("q"), "ent", "n", "comp", F.lit(0).cast("long").alias("blk"), "members")
    large = member.where(F.col("members") > block).repartitionByRange("tile", "comp", "n", "ent").sortWithinPartitions("tile", "comp", "n", "ent")
    large = ws.save(large.mapInArrow(_places, "tile long, ent long, n long, comp long, members long, part int, place long"), "places")
    before = large.groupBy("tile", "part").agg(F.count("*").alias("n")).select("tile", "part", (F.sum("n").over(Window.partitionBy("tile").orderBy("part")) - F.col("n")).alias("before"))
    large = ws.save(large.join(before, ["tile", "part"]).select("tile", "ent", "n", "comp", "members", F.floor((F.col("before") + F.col("place")) / block).alias("blk")), "blocks")
    span = large.groupBy("tile", "blk").agg(F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("comp").alias("one"), F.max("comp").alias("end"))
    s, t = span.alias("s"), span.alias("t")
    differ = (F.col("s.one") != F.col("t.end")) | (F.col("s.end") != F.col("t.one"))
    fits = (F.col("t.lo") * percent <= F.col("s.hi") * 100) & (F.col("s.lo") * percent <= F.col("t.hi") * 100)
    meets = s.join(t, (F.col("s.tile") == F.col("t.tile")) & (F.col("s.blk") <= F.col("t.blk")) & differ & fits).select(F.col("s.tile"), F.col("s.blk").alias("p"), F.col("t.blk").alias("q"))
    large = meets.select("tile", "p", "q", F.explode(F.array_distinct(F.array("p", "q"))).alias("blk")).join(large, ["tile", "blk"]).select("tile", "p", "q", "ent", "n", "comp", "blk", "members")
    rows = ws.save(small.unionByName(large).drop("members"), "rows")
    bits = classes.select("ent", "bits")

    def compared(rows: DataFrame, vague: int | None) -> DataFrame:
        dealt = rows.select("tile", "p", "q", "ent", "n", "comp", "blk", "bits", "short").repartition("tile", "p", "q").sortWithinPartitions("tile", "p", "q", "n")
        return ws.save(dealt.mapInArrow(_within(percent, vague), "a long, b long, bound long, told boolean, tile long, p long, q long"), "compared")

    found = compared(rows.join(bits, "ent").withColumn("short", F.lit(None).cast("binary")), VAGUE)
    again = ws.save(rows.join(found.where("a IS NULL").select("tile", "p", "q"), ["tile", "p", "q"]), "again")
    if not again.isEmpty():
        shorts = _asked_sets(ws, again.select("ent"), texts, classes, k, True).dropDuplicates(["ent"]).withColumnRenamed("s", "short")
        found = found.unionByName(compared(again.join(bits, "ent").join(shorts, "ent", "left"), None))
    rest = found.where("a IS NOT NULL").groupBy("a", "b").agg(F.min(F.when(F.col("told"), F.col("bound"))).alias("bound"))
    rest = ws.save(rest, "rest")
    # pairs that only bitmaps let through are told by short shingles as well
    vague = _links(ws, rest.where("bound IS NULL").select("a", "b"), texts, classes, k, percent, brief=True).distinct()
    return ws.save(rest.where("bound IS NOT NULL").unionByName(vague.toDF("a", "b", "bound")), "close")


def jaccard_components(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75, common: int = COMMON, hot: int = HOT, block: int = BLOCK) -> DataFrame:
    """(id, n_shingles, component_id) for every row of docs; see the module for what is linked."""
    ws = Workspace(spark, "jaccard")
    texts, rows, classes, met = _classes(ws, docs, id_col, text_col, k, percent, common, hot)
    # a first choice only, so half of what a link needs will do: not each tile of two classes has the same least class
    votes = met.where((F.col("kind") == MEMBER) & (2 * F.col("votes") >= F.col("need")))
    votes = ws.save(votes.withColumn("r", F.row_number().over(Window.partitionBy("b").orderBy(F.desc("votes"), "a"))).where(F.col("r") <= TRIES).select("a", "b", "n"), "votes")
    ring = votes.repartitionByRange("a", "b").sortWithinPartitions("a", "b").mapInArrow(_ring(percent), "a long, b long")
    tries = ws.save(votes.select("a", "b").unionByName(ring).unionByName(met.where(F.col("kind") == PAIR).select("a", "b")).distinct(), "tries")
    tries = _fit(ws, tries, classes, percent)
    links = ws.save(_links(ws, tries, texts, classes, k, percent).select("u", "v").distinct(), "links")

    roots = ws.save(components(ws, links), "roots")
    rest = _close(ws, met, classes, texts, roots, k, percent, block)
    # the likeliest partner of each class first, then that in each other component, then all pairs that are still apart
    for partners in ("one", "each", "all"):
        if partners == "one":
            chosen = [rest.groupBy(x).agg(F.max_by(y, F.struct("bound", y)).alias(y)).select("a", "b") for x, y in ("ab", "ba")]
        else:
            named = [roots.select(F.col("node").alias(x), F.col("root").alias(f"r{x}")) for x in "ab"]
            rest = rest.join(named[0], "a", "left").join(named[1], "b", "left").select("a", "b", "bound", F.coalesce("ra", "a").alias("ra"), F.coalesce("rb", "b").alias("rb"))
            rest = ws.save(rest.where("ra <> rb"), "apart")
            chosen = [rest.groupBy(x, f"r{y}").agg(F.max_by(y, F.struct("bound", y)).alias(y)).select("a", "b") for x, y in ("ab", "ba")] if partners == "each" else [rest.select("a", "b")]
            rest = rest.select("a", "b", "bound")
        chosen = ws.save(reduce(DataFrame.unionByName, chosen).distinct(), "chosen")
        if chosen.isEmpty():
            break
        more = ws.save(_links(ws, chosen, texts, classes, k, percent).select("u", "v").distinct(), "more")
        if not more.isEmpty():  # the roots so far stand for the links so far
            links = more.unionByName(roots.select(F.col("node").alias("u"), F.col("root").alias("v")))
            roots = ws.save(components(ws, links), "roots")

    linked = classes.where("n > 0").select("ent", "rep").join(roots, F.col("ent") == roots.node, "left").select("ent", "rep", F.coalesce("root", "ent").alias("comp"))
    named = linked.groupBy("comp").agg(F.min("rep").alias("component_id")).join(linked, "comp").select("ent", "component_id")
    out = rows.join(named, "ent", "left")
    return out.select(F.col("id").alias(id_col), F.col("n").alias("n_shingles"), F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def jaccard_links(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, percent: int = 75, common: int = COMMON, hot: int = HOT, block: int = BLOCK) -> tuple[DataFrame, DataFrame]:
    """All links (a, b, a < b) between classes of texts, by the least id of each, and the members (id, class id) of the classes.

    Members of a class are linked with each other besides. Pairs within components are tested, too, so a group of g near copies costs g * g tests.
    """
    ws = Workspace(spark, "links")
    texts, rows, classes, met = _classes(ws, docs, id_col, text_col, k, percent, common, hot)
    apart = spark.createDataFrame([], "node long, root long")
    close = _close(ws, met, classes, texts, apart, k, percent, block).select("a", "b").unionByName(_fit(ws, ws.save(met.where(F.col("kind") == PAIR).select("a", "b"), "counted"), classes, percent)).distinct()
    found = ws.save(_links(ws, ws.save(close, "pairs"), texts, classes, k, percent).select("u", "v").distinct(), "links")
    named = [classes.select(F.col("ent").alias(x), F.col("rep").alias(f"r{x}")) for x in "uv"]
    links = found.join(named[0], "u").join(named[1], "v").select(F.least("ru", "rv").alias("a"), F.greatest("ru", "rv").alias("b")).distinct()
    members = rows.where("n > 0 AND id IS NOT NULL").join(classes.select("ent", "rep"), "ent").select(F.col("id").alias(id_col), F.col("rep").alias("class_id")).distinct()
    return links, members


def link_counts(spark: SparkSession, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how: int) -> DataFrame:
    """(id, n_links) of each id with a text: how many others its text is linked with, equal ones included."""
    links, members = jaccard_links(spark, docs, id_col, text_col, **how)
    sizes = members.groupBy("class_id").agg(F.count("*").alias("n"))
    ways = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    others = ways.join(sizes, F.col("b") == F.col("class_id")).groupBy("a").agg(F.sum("n").alias("others"))
    told = sizes.join(others, F.col("class_id") == F.col("a"), "left").select("class_id", (F.col("n") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"))
    return members.join(told, "class_id").select(id_col, "n_links")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(spark, table(spark, sf_dir, "documents"))
