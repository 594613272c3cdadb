"""Induced suffix sorting with common prefixes, in batches, through disk-backed monotone priority queues."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Suffix tuples that a sort may hold in memory; beyond that they go to unnamed files of the task, which vanish with it.
IN_MEMORY = 1 << 23
#: Tuples that are handled at once.
CHUNK = 1 << 20
TUPLE = np.dtype([("place", "<i8"), ("common", "u1")])


class Store:
    """What all runs of a sort hold in memory together. Beyond limit tuples every run's go to its file."""

    def __init__(self, limit: int = IN_MEMORY):
        self.limit, self.held, self.most, self.spilled, self.runs = limit, 0, 0, 0, []

    def run(self) -> Run:
        self.runs.append(Run(self))
        return self.runs[-1]

    def grown(self, n: int) -> None:
        self.held += n
        self.most = max(self.most, self.held)
        if self.held > self.limit:
            self.spilled += self.held
            for r in self.runs:
                r.spill()
            self.held = 0

    def array(self, n: int, kind) -> np.ndarray:
        """An array of zeros that is mapped from a file if it is larger than the limit."""
        if n <= max(self.limit, 1):
            return np.zeros(n, kind)
        f = tempfile.TemporaryFile()
        f.truncate(n * np.dtype(kind).itemsize)
        return np.memmap(f, kind, "r+", shape=n)


class Run:
    """Suffix tuples in order, appended to at the end and read from either end, in memory or in a file."""

    def __init__(self, store: Store):
        self.store, self.parts, self.file, self.n = store, [], None, 0

    def append(self, t: np.ndarray) -> None:
        if len(t):
            self.parts.append(t)
            self.n += len(t)
            self.store.grown(len(t))

    def spill(self) -> None:
        if self.parts:
            self.file = self.file or tempfile.TemporaryFile()
            self.file.seek(0, 2)
            for t in self.parts:
                self.file.write(t.tobytes())
            self.parts = []

    def close(self) -> None:
        self.store.held -= sum(map(len, self.parts))
        self.store.runs.remove(self)
        if self.file:
            self.file.close()
        self.parts, self.file = [], None

    def _held(self) -> np.ndarray:
        """The tuples in memory, as one array."""
        if len(self.parts) > 1:
            self.parts = [np.concatenate(self.parts)]
        return self.parts[0]

    def _filed(self) -> int:
        return self.n - sum(map(len, self.parts))

    def _slice(self, a: int, z: int) -> np.ndarray:
        self.file.seek(a * TUPLE.itemsize)
        return np.frombuffer(bytearray(self.file.read((z - a) * TUPLE.itemsize)), TUPLE)

    def chunks(self) -> Iterator[np.ndarray]:
        """From the first tuple on. The run must not grow meanwhile, but may spill."""
        at = 0
        while at < self.n:
            filed, z = self._filed(), min(at + self._size(), self.n)
            if at < filed:
                z = min(z, filed)
                yield self._slice(at, z)
            else:
                yield self._held()[at - filed : z - filed]
            at = z

    def falling(self) -> Iterator[np.ndarray]:
        """Chunks from the last tuple to the first; common is then that with the tuple before in this order, but for the
        very first."""
        z, carried = self.n, None
        while z > 0:
            filed, a = self._filed(), max(0, z - self._size())
            if z > filed:
                a = max(a, filed)
                t = self._held()[a - filed : z - filed]
            else:
                t = self._slice(a, z)
            down = np.empty(len(t), TUPLE)
            down["place"], down["common"][1:], down["common"][0] = t["place"][::-1], t["common"][:0:-1], 0 if carried is None else carried
            carried, z = int(t["common"][0]), a
            yield down

    def _size(self) -> int:
        return max(1, min(CHUNK, self.store.limit))


class Queues:
    """A priority queue of suffix tuples (place, common prefix with the tuple before), keyed by first character and rank.

    Induction pushes tuples of one character in ascending order of rank, so each character's tuples are a run that is
    only appended to and taken from its front: the heap is an array of runs, in files as far as memory ends.
    """

    def __init__(self, store: Store):
        self.store, self.runs = store, {}

    def push(self, char: int, place: np.ndarray, common: np.ndarray) -> None:
        t = np.empty(len(place), TUPLE)
        t["place"], t["common"] = place, common
        if char not in self.runs:
            self.runs[char] = self.store.run()
        self.runs[char].append(t)

    def taken(self, char: int) -> Iterator[np.ndarray]:
        """Chunks of a character's tuples in order, also those that are pushed meanwhile."""
        while char in self.runs:
            run = self.runs.pop(char)
            yield from run.chunks()
            run.close()


def kinds(text: np.ndarray, store: Store) -> np.ndarray:
    """True where a suffix is smaller than the next one (type S); the last one is. Taken in pieces from the end."""
    out, z, above = store.array(len(text), bool), len(text), True
    while z > 0:
        a = max(0, z - max(1, min(CHUNK, store.limit)))
        own, then = text[a:z], text[a + 1 : z + 1]
        less, more = np.zeros(z - a, bool), np.zeros(z - a, bool)
        n = len(then)
        less[:n], more[:n] = own[:n] < then, own[:n] > then
        if n < len(own):
            less[-1] = True
        decided = less | more
        nearest = np.minimum.accumulate(np.where(decided, np.arange(z - a), z - a)[::-1])[::-1]
        out[a:z] = np.append(less, above)[nearest]
        above, z = bool(out[a]), a
    return out


def _common(text: np.ndarray, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
    """Common prefixes of suffixes a[k] and b[k], at most limit. Pairs that still agree go on."""
    out, left, room = np.zeros(len(a), np.uint8), np.arange(len(a)), np.concatenate([text, np.zeros(0, text.dtype)])
    for k in range(limit):
        x, y = a[left] + k, b[left] + k
        ok = (x < len(room)) & (y < len(room))
        ok[ok] = room[x[ok]] == room[y[ok]]
        left = left[ok]
        if not len(left):
            break
        out[left] += 1
    return out


def starred(text: np.ndarray, small: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """(places, common prefixes) of the leftmost type-S suffixes in the order of their first limit characters.

    They are named by their substrings up to the next such place; the sequence of names is then sorted as suffixes of
    suffixes by doubling, as far as limit characters reach.
    """
    star = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if not len(star):
        return star, np.zeros(0, np.uint8)
    ends = np.append(star[1:] + 1, len(text))  # a substring ends with the first character of the next
    eight = np.concatenate([text, np.full(8, 255, np.uint8)]).astype(np.uint64)
    for k in (1, 2, 4):  # of each place, its eight characters as one number
        eight = eight[:-k] << np.uint64(8 * k) | eight[k:]
    filled = np.array([2**64 - 1 >> 8 * k for k in range(8)] + [0], np.uint64)

    def named(rank: np.ndarray, who: np.ndarray, key: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Splits the classes of who by key: their new ranks go into rank; (who in order, class numbers, class sizes)."""
        order = np.argsort(key)
        order = order[np.argsort(rank[who][order], kind="stable")] if rank[who].any() else order
        r, k = rank[who][order], key[order]
        head = np.concatenate(([True], r[1:] != r[:-1]))
        new = head | np.concatenate(([True], k[1:] != k[:-1]))
        at = np.arange(len(r))
        rank[who[order]] = r + np.maximum.accumulate(np.where(new, at, 0)) - np.maximum.accumulate(np.where(head, at, 0))
        number = np.cumsum(new) - 1
        return who[order], number, np.bincount(number)

    rank, who, at = np.zeros(len(star), np.int64), np.arange(len(star)), 0
    while len(who):  # eight characters more of those that are still equal
        room = np.clip(ends[who] - star[who] - at, 0, 8)
        key = eight[np.minimum(star[who] + at, len(text) - 1)] | filled[room]
        key[room == 0] = filled[0]
        who, number, size = named(rank, who, key)
        at += 8
        open_ = (np.bincount(number, weights=star[who] + at < ends[who]) > 0) & (size > 1)
        who = who[open_[number]]
    size, step = np.bincount(rank, minlength=len(rank)), 1
    who = np.flatnonzero(size[rank] > 1)
    while 2 * step < limit and len(who):  # by step names more; a name and the next differ by two characters at least
        follow = np.where(who + step < len(rank), rank[np.minimum(who + step, len(rank) - 1)], -1)
        who, number, size = named(rank, who, follow)
        who = who[(size > 1)[number]]
        step *= 2
    places = star[np.argsort(rank, kind="stable")]
    return places, np.concatenate(([0], _common(text, places[:-1], places[1:], limit))).astype(np.uint8)


def _keys(text: np.ndarray, places: np.ndarray, limit: int) -> np.ndarray:
    """The first limit characters of suffixes as byte strings."""
    at = places[:, None] + np.arange(limit)
    chars = text[np.minimum(at, len(text) - 1)]
    chars[at >= len(text)] = 0
    return np.ascontiguousarray(chars).view(f"S{limit}")[:, 0]


def merged_stars(text: np.ndarray, small: np.ndarray, limit: int, store: Store) -> Run:
    """What starred() gives, for texts beyond memory: sorted pieces in files, merged."""
    piece = max(64, store.limit // 8)
    pieces, out = [], store.run()
    for a in range(0, len(text), piece):
        own = small[a : a + piece] & ~np.append(True if a == 0 else small[a - 1], small[a : a + piece][:-1])
        t = np.zeros(int(own.sum()), TUPLE)
        t["place"] = np.flatnonzero(own) + a
        pieces.append(store.run())
        pieces[-1].append(t[np.argsort(_keys(text, t["place"], limit), kind="stable")])
        pieces[-1].spill()
    streams = [(lambda r, n: (r._slice(k, min(k + n, r._filed())) for k in range(0, r._filed(), n)))(r, max(8, piece // len(pieces))) for r in pieces]
    heads = [next(s, None) for s in streams]
    heads = [h if h is None else (h["place"], _keys(text, h["place"], limit)) for h in heads]
    last = None
    while any(h is not None for h in heads):
        edge = min(h[1][-1] for h in heads if h is not None)  # nothing up to here can still come
        took = []
        for k, h in enumerate(heads):
            if h is not None and (n := int(np.searchsorted(h[1], edge, side="right"))):
                took.append((h[0][:n], h[1][:n]))
                heads[k] = (h[0][n:], h[1][n:]) if n < len(h[0]) else None
                if heads[k] is None and (more := next(streams[k], None)) is not None:
                    heads[k] = (more["place"], _keys(text, more["place"], limit))
        place = np.concatenate([x[0] for x in took])
        place = place[np.argsort(np.concatenate([x[1] for x in took]), kind="stable")]
        t = np.empty(len(place), TUPLE)
        t["place"], t["common"][1:] = place, _common(text, place[:-1], place[1:], limit)
        t["common"][0] = 0 if last is None else _common(text, last, place[:1], limit)[0]
        last = place[-1:]
        out.append(t)
    for r in pieces:
        r.close()
    return out


class _Least:
    """Range minima over a batch's common prefixes."""

    def __init__(self, x: np.ndarray):
        self.levels = [x]
        while len(self.levels[-1]) > 1 << (len(self.levels) - 1):
            w, last = 1 << (len(self.levels) - 1), self.levels[-1]
            self.levels.append(np.minimum(last[:-w], last[w:]))

    def between(self, a: np.ndarray, z: np.ndarray) -> np.ndarray:
        """Least of x[a .. z], ends included."""
        width = z - a + 1
        level = np.frexp(width.astype(np.float64))[1] - 1
        out = np.empty(len(a), np.uint8)
        for k in np.unique(level).tolist():
            m = level == k
            out[m] = np.minimum(self.levels[k][a[m]], self.levels[k][z[m] - (1 << k) + 1])
        return out


def _induce(text, small, kind, batch, queues, since, limit):
    """Pushes the suffixes before those of batch that are of the kind (small: type S); since[c] is the least common prefix that went by after
    the last push of character c (limit + 1: none was pushed)."""
    place, common = batch["place"], np.minimum(batch["common"], limit)
    since[:] = np.where(since > limit, since, np.minimum(since, common[0]))  # the step into this batch
    before = place - 1
    ok = before >= 0
    ok[ok] = small[before[ok]] if kind else ~small[before[ok]]
    at = np.flatnonzero(ok)
    least = _Least(common)
    if len(at):
        chars = text[before[at]]
        order = np.argsort(chars, kind="stable")
        at, chars = at[order], chars[order]
        cuts = np.flatnonzero(np.concatenate(([True], chars[1:] != chars[:-1], [True])))
        shared = np.empty(len(at), np.uint8)
        inner = np.ones(len(at), bool)
        inner[cuts[:-1]] = False
        k = np.flatnonzero(inner)
        shared[k] = np.minimum(least.between(at[k - 1] + 1, at[k]) + 1, limit)
    whole = int(common[1:].min()) if len(common) > 1 else limit
    now = np.where(since > limit, since, np.minimum(since, whole))
    if len(at):
        for a, z in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            c = int(chars[a])
            if since[c] > limit:
                shared[a] = 0
            else:
                head = int(least.between(np.array([1]), at[a : a + 1])[0]) if at[a] > 0 else limit
                shared[a] = min(min(int(since[c]), head) + 1, limit)
            queues.push(c, before[at[a:z]], shared[a:z])
            tail = int(least.between(at[z - 1 : z] + 1, np.array([len(common) - 1]))[0]) if at[z - 1] + 1 < len(common) else limit
            now[c] = tail
    since[:] = now


def sorted_suffixes(text: np.ndarray, limit: int, in_memory: int = IN_MEMORY, store: Store | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Chunks (places, common): all suffixes of a byte text in the order of their first limit characters, and each one's
    common prefix with the one before, at most limit. The text must end with its only 0 and hold no 255; it may be mapped
    from a file.

    Leftmost type-S suffixes are sorted first; they induce type L in ascending order, and those type S in descending
    order. Every step takes a chunk of a character's run from the queue, and common prefixes are induced with the
    suffixes: of two that are pushed in turn, one more than the least common prefix between what induced them. Runs,
    results and the leftmost suffixes' order go to files beyond in_memory tuples.
    """
    store = store or Store(in_memory)
    if len(text) < 2:
        yield np.arange(len(text)), np.zeros(len(text), np.uint8)
        return
    small = kinds(text, store)
    if len(text) <= store.limit:
        stars, (place, common) = store.run(), starred(text, small, limit)
        t = np.empty(len(place), TUPLE)
        t["place"], t["common"] = place, common
        stars.append(t)
    else:
        stars = merged_stars(text, small, limit, store)
    upper, since = Queues(store), np.full(256, limit + 1, np.int64)
    ordered: dict[int, Run] = {}  # type-L runs by character
    last = -1  # place of the suffix that was handled last
    coming, held, heads = stars.chunks(), np.empty(0, TUPLE), text[:0]
    for c in range(256):
        for batch in upper.taken(c):
            if c not in ordered:
                batch["common"][0] = 0
                ordered[c] = store.run()
            _induce(text, small, False, batch, upper, since, limit)
            ordered[c].append(batch)
            last = int(batch["place"][-1])
        first = True
        while True:  # the leftmost type-S suffixes of the character
            if not len(held):
                held = next(coming, held)
                heads = text[held["place"]]
            n = int(np.searchsorted(heads, c, side="right"))
            if not n:
                break
            batch, held, heads = held[:n], held[n:], heads[n:]
            if first:
                batch["common"][0] = _common(text, np.array([last]), batch["place"][:1], limit)[0] if last >= 0 and text[last] == c else 0
            first = False
            _induce(text, small, False, batch, upper, since, limit)
            last = int(batch["place"][-1])
    stars.close()
    lower, since = Queues(store), np.full(256, limit + 1, np.int64)
    falling: dict[int, Run] = {}  # type-S runs by character, descending
    last = -1
    final = np.zeros(1, TUPLE)
    final["place"] = len(text) - 1
    for c in range(255, -1, -1):
        for batch in lower.taken(c):
            if c not in falling:
                batch["common"][0] = 0
                falling[c] = store.run()
            _induce(text, small, True, batch, lower, since, limit)
            falling[c].append(batch)
            last = int(batch["place"][-1])
        if c == 0:
            falling[c] = falling.get(c) or store.run()
            falling[c].append(final)
            last = int(final["place"][0])
            _induce(text, small, True, final, lower, since, limit)
        for k, down in enumerate(ordered[c].falling() if c in ordered else ()):
            if k == 0:
                down["common"][0] = _common(text, np.array([last]), down["place"][:1], limit)[0] if last >= 0 and text[last] == c else 0
            _induce(text, small, True, down, lower, since, limit)
            last = int(down["place"][-1])
    last = -1
    for c in range(256):
        for batch in ordered[c].chunks() if c in ordered else ():
            yield batch["place"], batch["common"]
            last = int(batch["place"][-1])
        for k, up in enumerate(falling[c].falling() if c in falling else ()):
            if k == 0 and c in ordered:
                up["common"][0] = _common(text, np.array([last]), up["place"][:1], limit)[0]
            yield up["place"], up["common"]
        for runs in (ordered, falling):
            if c in runs:
                runs[c].close()
