"""Cutting batches of text into the units within which a tokenizer merges, with numpy.

A merge never crosses the border of a unit, so the ids of a text are those of its units in
order, and each different unit is worked out once per worker. Units are found on the code
points of a whole batch at a time. A hash brings equal ones together, and their code points are
then compared; a worker's memo goes by the unit itself.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator, Sequence
from contextlib import suppress
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa

#: Characters handled at a time; a longer text makes a longer chunk of its own.
CHUNK = 500_000
#: Chunks whose new units are worked out together.
TOGETHER = 4
SPACE, LETTER, NUMBER, OTHER = 0, 1, 2, 3


@lru_cache(maxsize=1)
def char_classes() -> np.ndarray:
    """Class of every code point, as the byte-level pattern sees it: white space, letter, number, other."""
    import unicodedata

    import regex

    classes = np.full(0x110000, OTHER, np.uint8)
    codes = np.arange(0x110000, dtype=np.uint32)
    every = codes[(codes < 0xD800) | (codes >= 0xE000)].tobytes().decode("utf-32-le")
    for kind, pattern in ((LETTER, r"\p{L}"), (NUMBER, r"\p{N}")):
        found = "".join(regex.findall(pattern, every))
        classes[np.frombuffer(found.encode("utf-32-le"), np.uint32)] = kind
    spaces = [c for c in every if unicodedata.category(c) in ("Zs", "Zl", "Zp")] + list("\t\n\x0b\x0c\r\x85")
    classes[[ord(c) for c in spaces]] = SPACE
    return classes


_P = 0x9E3779B97F4A7C55  # odd, so it has an inverse modulo 2**64


@lru_cache(maxsize=1)
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of a multiplier and of its inverse modulo 2**64."""
    out = []
    for base in (_P, pow(_P, -1, 1 << 64)):
        steps = np.full(n, base, np.uint64)
        steps[0] = 1
        out.append(np.multiply.accumulate(steps))
    return out[0], out[1]


def hashes(values: np.ndarray, starts: np.ndarray, skip: np.ndarray | None = None) -> np.ndarray:
    """A 64-bit hash of each run of ``values`` between consecutive ``starts``.

    ``skip`` marks values at the end of a run that don't count. A value and its place in the
    run are mixed together before they are summed, so no arrangement of values cancels out.
    """
    first = int(starts[0])
    lengths = np.diff(np.append(starts, len(values)))
    terms = values[first:].astype(np.uint64)
    terms <<= np.uint64(32)
    terms += np.arange(first, len(values), dtype=np.uint64)
    terms -= np.repeat(starts.astype(np.uint64), lengths)
    terms += np.uint64(1)
    terms *= np.uint64(0xBF58476D1CE4E5B9)
    terms ^= terms >> np.uint64(29)
    terms *= np.uint64(0x94D049BB133111EB)
    terms ^= terms >> np.uint64(32)
    if skip is not None:
        terms[skip[first:]] = 0
    return mixed(np.add.reduceat(terms, starts - first))


def mixed(x: np.ndarray) -> np.ndarray:
    """Bits of ``x`` spread over the whole word."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def chunks(texts: Sequence[str]) -> Iterator[tuple[int, int]]:
    """Ranges of texts that have about ``CHUNK`` characters together."""
    first = size = 0
    for i, text in enumerate(texts):
        if size and size + len(text) > CHUNK:
            yield first, i
            first, size = i, 0
        size += len(text)
    if first < len(texts):
        yield first, len(texts)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def byte_level_starts(codes: np.ndarray, text: str, cuts: np.ndarray, special: Sequence[str]) -> np.ndarray:
    """Where the pieces of the byte-level pattern start, as a mask over ``codes``.

    The pattern: contractions, then runs of letters, of numbers and of other signs with a
    space before them, then white space, of which the last sign stays apart when text
    follows. ``cuts`` are the starts of texts. Strings in ``special`` are pieces whole.
    """
    n = len(codes)
    inside = np.zeros(n, bool)
    held: list[int] = []
    for mark in special:
        at = text.find(mark)
        while at >= 0:
            ends = at + len(mark)
            if not np.any((cuts > at) & (cuts < ends)):
                inside[at + 1 : ends] = True
                held += [at, ends]
                at = text.find(mark, ends)
            else:
                at = text.find(mark, at + 1)
    first = np.zeros(n + 1, bool)
    first[cuts] = True
    first[held] = True
    first[n] = True
    kind = char_classes()[codes]
    change = np.empty(n, bool)
    change[0] = True
    np.not_equal(kind[1:], kind[:-1], out=change[1:])
    start = change | first[:-1]
    blank = kind == SPACE
    # The last white space before other text in the same section is apart.
    start[:-1] |= blank[:-1] & ~blank[1:] & ~first[1:-1]
    # A space before a run belongs to the run.
    after_space = (codes[:-1] == 32) & ~blank[1:] & ~first[1:-1]
    start[1:] &= ~after_space
    marks = np.flatnonzero(start & (codes == 39))
    if len(marks):
        padded = np.concatenate([codes, np.zeros(3, np.uint32)])
        limit = np.concatenate([first, np.ones(3, bool)])
        one, two = padded[marks + 1], padded[marks + 2]
        near = ~limit[marks + 1]
        single = near & np.isin(one, [ord(c) for c in "stmd"])
        pair = ((one == 114) | (one == 118)) & (two == 101) | (one == 108) & (two == 108)
        double = near & ~limit[marks + 2] & pair
        for chosen, length in ((marks[single], 1), (marks[double], 2)):
            start[chosen + 1] = False
            after = chosen + 1 + length
            start[after[after < n]] = True
    start[inside] = False
    return start


class Joinable:
    """Cuts text wherever no vocabulary entry holds both neighbouring characters."""

    def __init__(self, entries: Sequence[str]):
        letters = sorted(set("".join(entries)))
        self.number = np.zeros(0x110000, np.uint16)
        self.number[[ord(c) for c in letters]] = np.arange(1, len(letters) + 1)
        self.pairs = np.zeros((len(letters) + 1, len(letters) + 1), bool)
        for entry in entries:
            at = self.number[[ord(c) for c in entry]]
            self.pairs[at[:-1], at[1:]] = True

    def starts(self, codes: np.ndarray, cuts: np.ndarray) -> np.ndarray:
        at = self.number[codes]
        start = np.ones(len(codes), bool)
        np.logical_not(self.pairs[at[:-1], at[1:]], out=start[1:])
        start[cuts] = True
        return start


class PairTable:
    """Index of integer keys: :meth:`find` gives the place of each key, -1 for none."""

    BITS, DEEP = 18, 4

    def __init__(self, keys: np.ndarray):
        self.keys = keys
        slots = self._slot(keys)
        order = np.argsort(slots, kind="stable")
        ranked = slots[order]
        depth = np.arange(len(keys)) - np.searchsorted(ranked, ranked)
        self.deep = int(depth.max(initial=0)) + 1
        self.table = np.full((self.deep, 1 << self.BITS), -1, np.int32)
        self.table[depth, ranked] = order

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.BITS)).astype(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        slots = self._slot(keys)
        found = np.full(len(keys), -1, np.int64)
        todo = np.arange(len(keys))
        for level in self.table:
            at = level[slots]
            filled = at >= 0
            hit = filled & (self.keys[at] == keys)
            found[todo[hit]] = at[hit]
            go = filled & ~hit
            if not go.any():
                break
            todo, slots, keys = todo[go], slots[go], keys[go]
        return found


class Memo:
    """Values of units, kept in a worker between batches.

    ``compute(list of new units) -> list of values``, none of them None. There are two
    generations: when the young one has ``limit`` units, or ``room`` for their signs and
    values, it becomes the old one, and what the old one had and nobody asked for is gone.
    Units of more than ``LONG`` signs are not kept. So memory is bounded, and the results do
    not depend on it. A worker keeps one memo: the first use of another gives up what the one
    before held, and calls its ``forget`` for what was loaded with it.
    """

    LONG = 256
    _live: Memo | IdMemo | None = None

    def __init__(self, compute: Callable[[list[str]], list], forget: Callable[[], None], limit: int = 200_000, room: int = 16 << 20):
        self.compute, self.forget, self.limit, self.room = compute, forget, limit, room
        self.clear()

    def clear(self) -> None:
        self.young: dict[str, object] = {}
        self.old: dict[str, object] = {}
        self.held = 0

    def fill(self, parts: list[Chunk]) -> list[list]:
        """The values of each chunk's units; all new ones of the batch are computed at once."""
        hold(self)
        if len(self.young) > self.limit or self.held > self.room:
            self.old, self.young, self.held = self.young, {}, 0
        names = [part.units for part in parts]
        out = [list(map(self.young.get, some)) for some in names]
        missed: dict[str, object] = {}
        for some, values in zip(names, out, strict=True):
            if None in values:
                missed.update(dict.fromkeys([u for u, v in zip(some, values, strict=True) if v is None]))
        if missed:
            found = dict(zip(missed, map(self.old.get, missed), strict=True)) if self.old else missed
            new = [u for u, v in found.items() if v is None]
            if new:
                found.update(zip(new, self.compute(new), strict=True))
            kept = found if max(map(len, found)) <= self.LONG else {u: v for u, v in found.items() if len(u) <= self.LONG}
            self.young.update(kept)
            if kept is found:  # all units are young now
                out = [list(map(self.young.__getitem__, some)) if None in values else values for some, values in zip(names, out, strict=True)]
            else:
                out = [[found[u] if v is None else v for u, v in zip(some, values, strict=True)] for some, values in zip(names, out, strict=True)]
            self.held += sum(map(len, kept)) + 8 * len(kept)
        return out


def equal_runs(a: np.ndarray, of_a: np.ndarray, b: np.ndarray, of_b: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Whether the runs of ``lengths`` (none 0) that start at ``of_a`` in ``a`` and at ``of_b`` in ``b`` are equal."""
    same = runs(a, of_a, lengths) == runs(b, of_b, lengths)
    if same.all():
        return np.ones(len(lengths), bool)
    return np.logical_and.reduceat(same, np.cumsum(lengths) - lengths)


def runs(values: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The runs of ``values`` that start at ``begins``, one after another."""
    at = np.repeat(begins - (np.cumsum(lengths) - lengths), lengths)
    at += np.arange(len(at))
    return values[at]


class Held:
    """Units as flat arrays: hash, signs and ids of each, and the order of the hashes."""

    def __init__(self):
        self.sorted, self.order = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.codes, self.ids = np.zeros(0, np.uint32), np.zeros(0, np.uint32)
        self.begins, self.lengths, self.firsts, self.counts = (np.zeros(0, np.int32) for _ in range(4))

    def __len__(self) -> int:
        return len(self.order)

    def find(self, hashes: np.ndarray, codes: np.ndarray, begins: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """The number here of each unit, -1 where it is not held; signs are compared, not hashes alone."""
        found = np.full(len(hashes), -1, np.int64)
        if len(self) and len(hashes):
            at = np.minimum(np.searchsorted(self.sorted, hashes), len(self) - 1)
            here = self.order[at].astype(np.int64)
            hit = np.flatnonzero((self.sorted[at] == hashes) & (self.lengths[here] == lengths))
            mine = here[hit]
            same = equal_runs(codes, begins[hit], self.codes, self.begins[mine], lengths[hit])
            found[hit[same]] = mine[same]
        return found

    def add(self, hashes: np.ndarray, codes: np.ndarray, lengths: np.ndarray, ids: np.ndarray, counts: np.ndarray) -> None:
        """Units of different hashes; one whose hash another unit has here is left out by later searches."""
        order = np.argsort(hashes, kind="stable")
        at = np.searchsorted(self.sorted, hashes[order], side="right")
        self.sorted = np.insert(self.sorted, at, hashes[order])
        self.order = np.insert(self.order, at, (len(self.order) + order).astype(np.int32))
        self.begins = np.append(self.begins, (len(self.codes) + np.cumsum(lengths) - lengths).astype(np.int32))
        self.firsts = np.append(self.firsts, (len(self.ids) + np.cumsum(counts) - counts).astype(np.int32))
        self.lengths, self.counts = np.append(self.lengths, lengths.astype(np.int32)), np.append(self.counts, counts.astype(np.int32))
        self.codes, self.ids = np.append(self.codes, codes), np.append(self.ids, ids)


class IdMemo:
    """Token ids of units, kept in a worker between batches in arrays that are searched together.

    ``compute(list of new units) -> (ids, how many each has)``. Generations, bounds and the
    worker's one memo are as in :class:`Memo`; ``room`` is in signs and ids.
    """

    LONG = 256

    def __init__(self, compute: Callable[[list[str]], tuple[np.ndarray, np.ndarray]], forget: Callable[[], None], limit: int = 300_000, room: int = 4 << 20):
        self.compute, self.forget, self.limit, self.room = compute, forget, limit, room
        self.clear()

    def clear(self) -> None:
        self.young, self.old = Held(), Held()

    def fill(self, parts: list[Chunk]) -> tuple[np.ndarray, list[tuple[np.ndarray, np.ndarray]]]:
        """Ids, and for each chunk where those of its units start there, and how many there are."""
        hold(self)
        if len(self.young) > self.limit or len(self.young.codes) + len(self.young.ids) > self.room:
            self.old, self.young = self.young, Held()
        sizes = [len(p.begins) for p in parts]
        shift = np.cumsum([0, *(len(p.codes) for p in parts)])
        codes = np.concatenate([p.codes for p in parts])
        begins = np.concatenate([p.begins + a for p, a in zip(parts, shift.tolist(), strict=False)])
        lengths = np.concatenate([p.lengths for p in parts])
        # Where units of a chunk share a hash, none of them is looked up or kept.
        clear = np.repeat([p.hashes is not None for p in parts], sizes)
        hashes = np.concatenate([np.zeros(n, np.uint64) if p.hashes is None else p.hashes for p, n in zip(parts, sizes, strict=True)])
        at = np.full(len(begins), -1, np.int64)
        at[clear] = self.young.find(hashes[clear], codes, begins[clear], lengths[clear])
        firsts, counts = np.zeros(len(begins), np.int64), np.zeros(len(begins), np.int64)
        hit, miss = np.flatnonzero(at >= 0), np.flatnonzero((at < 0) & clear)
        firsts[hit], counts[hit] = self.young.firsts[at[hit]], self.young.counts[at[hit]]
        pool, end = [self.young.ids], len(self.young.ids)
        # One of each missed unit; those whose hash another missed one has are on their own.
        keys, lead, number = np.unique(hashes[miss], return_index=True, return_inverse=True)
        lead = miss[lead]
        alike = lengths[miss] == lengths[lead[number]]
        alike[alike] = equal_runs(codes, begins[miss[alike]], codes, begins[lead[number[alike]]], lengths[miss[alike]])
        before = self.old.find(keys, codes, begins[lead], lengths[lead])
        again, new = np.flatnonzero(before >= 0), lead[before < 0]
        alone = np.concatenate([new, miss[~alike], np.flatnonzero(~clear)])
        kept_ids = runs(self.old.ids, self.old.firsts[before[again]].astype(np.int64), self.old.counts[before[again]])
        counts[lead[again]] = self.old.counts[before[again]]
        fresh = np.zeros(0, np.uint32)
        if len(alone):
            owner = np.searchsorted(np.cumsum(sizes), alone, side="right")
            names = [""] * len(alone)
            base = np.cumsum([0, *sizes])
            for k in np.unique(owner).tolist():
                mine = np.flatnonzero(owner == k)
                for i, name in zip(mine.tolist(), parts[k].named(alone[mine] - base[k]), strict=True):
                    names[i] = name
            fresh, counts[alone] = self.compute(names)
        pool += [kept_ids, fresh]
        both = np.concatenate([lead[again], alone])
        firsts[both] = end + np.cumsum(counts[both]) - counts[both]
        follow = miss[alike]
        firsts[follow], counts[follow] = firsts[lead[number[alike]]], counts[lead[number[alike]]]
        pool = np.concatenate(pool)
        keep = np.concatenate([lead[again], new])
        keep = keep[lengths[keep] <= self.LONG]
        if len(keep):
            self.young.add(hashes[keep], runs(codes, begins[keep], lengths[keep]), lengths[keep], runs(pool, firsts[keep], counts[keep]), counts[keep])
        cuts = np.cumsum(sizes)[:-1]
        return pool, list(zip(np.split(firsts, cuts), np.split(counts, cuts), strict=True))


def hold(memo: Memo | IdMemo) -> None:
    """Make ``memo`` the one that this worker keeps."""
    if Memo._live is not memo:
        release()
        Memo._live = memo


def release() -> None:
    """Give up what this worker's memo holds. Operators that keep no memo call it before they allocate."""
    if drop():
        give_back()


def drop() -> bool:
    """Empty this worker's memo and what was loaded with it; whether there was one."""
    memo, Memo._live = Memo._live, None
    if memo is not None:
        memo.clear()
        memo.forget()
    return memo is not None


def give_back() -> None:
    """Return memory that this worker has freed, but keeps, to the system."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # where the C library can
        ctypes.CDLL(None).malloc_trim(0)


class Chunk:
    """Some texts cut into units: ``places`` has the unit of each place, an index into the units.

    ``hashes`` are those of the units, which differ; None where two units share one.
    """

    def __init__(self, texts: Sequence[str], starts_of: Callable[[np.ndarray, str, np.ndarray], np.ndarray]):
        self.text = text = "".join(texts)
        lengths = np.array([len(t) for t in texts], np.int64)
        none = np.zeros(0, np.int64)
        self.per_text, self.places, self.begins, self.lengths = np.zeros(len(texts), np.int64), none, none, none
        self.codes, self.hashes = np.zeros(0, np.uint32), np.zeros(0, np.uint64)
        if text:
            ends = np.cumsum(lengths)
            self.codes = codes = code_points(text)
            starts = np.flatnonzero(starts_of(codes, text, (ends - lengths)[lengths > 0]))
            sizes = np.diff(np.append(starts, len(codes)))
            self.places, firsts, self.hashes = _grouped(codes, starts)
            if firsts is None:  # two units share a hash
                known: dict[str, int] = {}
                found: list[int] = []
                self.hashes = None
                for i, (a, n) in enumerate(zip(starts.tolist(), sizes.tolist(), strict=True)):
                    if known.setdefault(text[a : a + n], len(known)) == len(found):
                        found.append(i)
                self.places = np.array([known[text[a : a + n]] for a, n in zip(starts.tolist(), sizes.tolist(), strict=True)], np.int64)
                firsts = np.array(found, np.int64)
            self.begins, self.lengths = starts[firsts], sizes[firsts]
            self.per_text = np.diff(np.searchsorted(starts, np.concatenate([[0], ends])))

    @property
    def units(self) -> list[str]:
        return self.named(np.arange(len(self.begins)))

    def named(self, which: np.ndarray) -> list[str]:
        """The units of these numbers as strings."""
        begins = self.begins[which]
        return [self.text[a:b] for a, b in zip(begins.tolist(), (begins + self.lengths[which]).tolist(), strict=True)]


def _grouped(codes: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray | None, np.ndarray]:
    """The group of each run of ``codes``, and the first run and the hash of each group; no first runs if a group's runs are not all equal."""
    places, keys = pd.factorize(hashes(codes, starts))
    firsts = np.empty(len(keys), np.int64)
    firsts[places[::-1]] = np.arange(len(places) - 1, -1, -1)
    lengths = np.diff(np.append(starts, len(codes)))
    first = firsts[places]
    if not np.array_equal(lengths, lengths[first]):
        return places, None, keys
    same = np.repeat(starts[first] - starts, lengths)
    same += np.arange(len(codes))
    return places, firsts if np.array_equal(codes[same], codes) else None, keys


def cut_texts(texts: Sequence[str], starts_of, together: int) -> Iterator[list[Chunk]]:
    """Chunks of the texts, ``together`` at a time."""
    ranges = list(chunks(texts))
    for i in range(0, len(ranges), together):
        yield [Chunk(texts[a:b], starts_of) for a, b in ranges[i : i + together]]


def counted(texts: Sequence[str], starts_of, memo: Memo) -> np.ndarray:
    """Sum of the memo's values over the units of each text."""
    out = [np.zeros(0, np.int64)]
    for parts in cut_texts(texts, starts_of, TOGETHER):
        for part, values in zip(parts, memo.fill(parts), strict=True):
            each = np.array(values, np.int64)[part.places]
            total = np.concatenate([[0], np.cumsum(each)])
            ends = np.cumsum(part.per_text)
            out.append(total[ends] - total[ends - part.per_text])
    return np.concatenate(out)


def joined(texts: Sequence[str], starts_of, memo: IdMemo, together: int = TOGETHER) -> Iterator[bytes]:
    """The memo's ids of the units of each text, in order, as bytes."""
    for parts in cut_texts(texts, starts_of, together):
        pool, found = memo.fill(parts)
        for part, (firsts, counts) in zip(parts, found, strict=True):
            each = counts[part.places]
            ids = runs(pool, firsts[part.places], each)
            total = np.concatenate([[0], np.cumsum(each)])
            ends = total[np.concatenate([[0], np.cumsum(part.per_text)])].tolist()
            for a, b in zip(ends, ends[1:], strict=False):
                yield ids[a:b].tobytes()
