"""Stretches of a text that repeat with a period, found on a grammar of its words.

The words of each document become numbers, and Re-Pair replaces the pair that occurs most
often by a new symbol until no pair occurs twice. All documents of a slice are compressed
side by side: in a round, each place where two symbols meet is replaced if its pair is more
frequent than those of the places next to it, then the places left over, and so on.

A rule stands for the same words wherever it was applied. A run lies in exactly one node of the
derivation that has it on both sides of its middle, so it is enough to look once at each
rule, at the runs that cross its middle: one side of the middle holds two periods, which
hashes of prefixes tell for every period, and binary searches extend them both ways. What is
left when no pair repeats is joined by a balanced tree of rules that are used once. Pairs
that occur once in the text cannot be in a run and separate these trees. The runs of a
rule are translated to all places where it was applied, and intervals of one period that
overlap by it are merged. Each result is compared with the words themselves; should a hash
have lied, the slice is worked off again with another one.

Nothing is shuffled, and no text is cut; a task holds one Arrow batch, worked off in slices of
bounded size (a longer text stands alone). Defined results: a null or empty text has no words
and no runs; an empty table gives an empty table; repeated rows are separate rows; all columns
are kept, and the new one gets another name if its name is taken.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripweave.functions.numbers import exact
from tripweave.llm.frames import free_name

#: A run is this many periods long at least, and this many words.
PERIODS = 4
LEAST = 6
#: Bytes of text that are compressed together, and periods that are tried together.
TOGETHER = 4 << 20
TRIED = 1 << 21
PRIMES = (2_147_483_647, 2_147_483_629)

RESULT = (
    "struct<n_words:bigint,runs:array<struct<start:bigint,length:bigint,period:bigint>>,"
    "collapsed:string>"
)
Nodes = tuple[np.ndarray, np.ndarray, np.ndarray]  # first word, middle, end


def _pairs(symbols: np.ndarray, link: np.ndarray, top: int):
    """Places where two linked symbols meet, the number of the pair there, whether the place is
    skipped because it overlaps an equal pair, and how often each pair occurs."""
    at = np.flatnonzero(link)
    key = symbols[at] * top + symbols[at + 1]
    _, pair = np.unique(key, return_inverse=True)
    n = np.arange(len(at))
    head = np.ones(len(at), bool)
    head[1:] = (at[1:] != at[:-1] + 1) | (pair[1:] != pair[:-1])
    odd = (n - np.maximum.accumulate(np.where(head, n, 0))) & 1 == 1
    return at, pair, odd, np.bincount(pair[~odd], minlength=int(pair.max()) + 1)


def _chosen(at: np.ndarray, pair: np.ndarray, count: np.ndarray, n: int) -> np.ndarray:
    """Places that do not overlap, most frequent pairs first; ties in a mixed order."""
    mixed = (pair.astype(np.uint64) * np.uint64(0x9E3779B1)) & np.uint64(0xFFFFFFFF)
    weight = np.zeros(n, np.uint64)
    weight[at] = count[pair].astype(np.uint64) << np.uint64(32) | mixed
    done = []
    while len(at):
        here = weight[at]
        best = (here > weight[at - 1]) & (here > weight[at + 1])
        won = at[best]
        done.append(won)
        for side in (-1, 0, 1):
            weight[won + side] = 0
        at = at[~best]
        at = at[weight[at] > 0]
    return np.sort(np.concatenate(done))


class Grammar:
    """Re-Pair over words (numbers; ``inner`` tells that a word and the next are one text)."""

    def __init__(self, words: np.ndarray, inner: np.ndarray):
        n = len(words)
        self.begin = np.ones(n, bool)  # where the symbols that are left begin
        self.joined = np.zeros(n, bool)  # pairs of words that occur twice
        self.rules: list[tuple[Nodes, np.ndarray, np.ndarray]] = []
        symbols, link = words.astype(np.int64), inner.copy()
        start, stop = np.arange(n), np.arange(1, n + 1)
        top, first = int(symbols.max(initial=0)) + 1, True
        while link.any():
            at, pair, odd, count = _pairs(symbols, link, top)
            dead = count[pair] < 2
            link[at[dead]] = False
            if first:
                self.joined, first = link.copy(), False
            use = ~dead & ~odd
            if not use.any():
                break
            places = np.zeros(len(symbols), np.int64)
            places[at] = pair
            chosen = _chosen(at[use], pair[use], count, len(symbols))
            twice = np.bincount(places[chosen], minlength=len(count)) >= 2
            chosen = chosen[twice[places[chosen]]]
            names, rule = np.unique(places[chosen], return_inverse=True)
            self._keep(rule, start[chosen], start[chosen + 1], stop[chosen + 1])
            self.begin[start[chosen + 1]] = False
            symbols[chosen], stop[chosen] = top + rule, stop[chosen + 1]
            link[chosen] = link[chosen + 1]
            top += len(names)
            stays = np.ones(len(symbols), bool)
            stays[chosen + 1] = False
            symbols, start, stop, link = (x[stays] for x in (symbols, start, stop, link))
            linked = link.copy()  # symbols without a neighbour are done
            linked[1:] |= link[:-1]
            symbols, start, stop, link = (x[linked] for x in (symbols, start, stop, link))

    def _keep(self, rule: np.ndarray, first: np.ndarray, middle: np.ndarray, end: np.ndarray):
        """Notes the rules that are long enough, and where each was applied."""
        long = end - first >= LEAST
        if not long.any():
            return
        rule, first, middle, end = (x[long] for x in (rule, first, middle, end))
        order = np.argsort(rule, kind="stable")
        heads = np.flatnonzero(np.diff(rule[order], prepend=-1))
        sample = order[heads]
        self.rules.append(
            ((first[sample], middle[sample], end[sample]), np.append(heads, len(order)), first[order])
        )

    def trees(self) -> Iterator[Nodes]:
        """Nodes of balanced trees over the symbols that are left, level by level."""
        n = len(self.begin)
        new = np.ones(n, bool)
        new[1:] = ~self.joined[:-1]
        heads = np.flatnonzero(new)
        ends = np.append(heads[1:], n)
        island = np.cumsum(new) - 1
        starts = np.flatnonzero(self.begin)
        starts = starts[(ends - heads)[island[starts]] >= LEAST]
        if not len(starts):
            return
        owner = island[starts]
        head = np.flatnonzero(np.diff(owner, prepend=-1))
        sizes = np.diff(np.append(head, len(starts)))
        nth = np.arange(len(starts)) - np.repeat(head, sizes)
        left = np.repeat(sizes, sizes) - nth  # symbols from here to the end
        step = 1
        while step < sizes.max():
            middle = np.flatnonzero(nth % (2 * step) == step)
            last = ends[owner[middle]]
            after = np.minimum(middle + step, len(starts) - 1)
            end = np.where(left[middle] > step, starts[after], last)
            yield starts[middle - step], starts[middle], end
            step *= 2


class Hashes:
    """Hashes of the prefixes of a list of numbers, modulo two primes."""

    def __init__(self, words: np.ndarray, seed: int):
        rng = np.random.default_rng(seed)
        self.sums, self.powers = [], []
        for prime in PRIMES:
            letter = rng.integers(1, prime, int(words.max(initial=0)) + 1)
            power = np.ones(len(words) + 1, np.int64)
            base, known = int(rng.integers(1 << 20, prime)), 1
            while known < len(power):
                more = min(known, len(power) - known)
                power[known : known + more] = power[:more] * pow(base, known, prime) % prime
                known += more
            total = np.cumsum(letter[words] * power[:-1] % prime)
            self.sums.append(np.concatenate([[0], total]))
            self.powers.append(power)

    def same(self, at: np.ndarray, period: np.ndarray, size: np.ndarray) -> np.ndarray:
        """Whether ``size`` words from ``at`` on equal those one period later."""
        equal = np.ones(len(at), bool)
        for prime, sums, powers in zip(PRIMES, self.sums, self.powers, strict=True):
            here = (sums[at + size] - sums[at]) % prime * powers[period] % prime
            later = (sums[at + period + size] - sums[at + period]) % prime
            equal &= here == later
        return equal


def _longest(fits, most: np.ndarray) -> np.ndarray:
    """The largest size up to ``most`` for which ``fits(size)`` holds, by binary search."""
    low, high = np.zeros(len(most), np.int64), most.copy()
    while (low < high).any():
        middle = (low + high + 1) // 2
        good = fits(middle)
        low, high = np.where(good, middle, low), np.where(good, high, middle - 1)
    return low


def _crossing(words: np.ndarray, hashes: Hashes, nodes: Nodes):
    """(node, start, end, period) of the runs that cross the middle of a node."""
    first, middle, end = nodes
    found = []
    for right in (True, False):
        side = end - middle if right else middle - first
        most = np.minimum(side // 2, (end - first) // PERIODS)
        total = np.concatenate([[0], np.cumsum(most)])
        block = 0
        while block < len(most):
            stop = int(np.searchsorted(total, total[block] + TRIED, side="right")) - 1
            stop = min(max(stop, block + 1), len(most))
            sizes = most[block:stop]
            node = np.repeat(np.arange(block, stop), sizes)
            period = 1 + np.arange(len(node)) - np.repeat(total[block:stop] - total[block], sizes)
            at = middle[node] if right else middle[node] - 2 * period
            alike = (words[at] == words[at + period]) & (
                words[at + period - 1] == words[at + 2 * period - 1]
            )
            node, period, at = node[alike], period[alike], at[alike]
            alike = hashes.same(at, period, period)
            node, period, at = node[alike], period[alike], at[alike]
            ahead = _longest(
                lambda k, at=at, p=period: hashes.same(at, p, k), end[node] - period - at
            )
            behind = _longest(
                lambda k, at=at, p=period: hashes.same(at - k, p, k), at - first[node]
            )
            found.append((node, at - behind, at + ahead + period, period))
            block = stop
    node, start, stop, period = (np.concatenate(x) for x in zip(*found, strict=True))
    long = stop - start >= np.maximum(LEAST, PERIODS * period)
    node, start, stop, period = (x[long] for x in (node, start, stop, period))
    order = np.lexsort((period, stop, start, node))
    node, start, stop, period = (x[order] for x in (node, start, stop, period))
    new = np.ones(len(node), bool)  # the smallest period of a stretch
    new[1:] = (node[1:] != node[:-1]) | (start[1:] != start[:-1]) | (stop[1:] != stop[:-1])
    return tuple(x[new] for x in (node, start, stop, period))


def _merged(start: np.ndarray, stop: np.ndarray, period: np.ndarray):
    """Stretches of one period that overlap by it become one."""
    order = np.lexsort((start, period))
    start, stop, period = (x[order] for x in (start, stop, period))
    if not len(start):
        return start, stop, period
    apart = np.cumsum(np.diff(period, prepend=period[0]) != 0) * (int(stop.max()) + 1)
    reach = np.maximum.accumulate(stop + apart)
    new = np.ones(len(start), bool)
    new[1:] = start[1:] + apart[1:] + period[1:] > reach[:-1]
    heads = np.flatnonzero(new)
    start, period = start[heads], period[heads]
    stop = np.maximum.reduceat(stop, heads)
    order = np.lexsort((period, start))
    return start[order], stop[order], period[order]


def find_runs(words: np.ndarray, inner: np.ndarray):
    """(start, stop, period) of all runs, sorted by start and period."""
    grammar = Grammar(words, inner)
    seed = 0
    while True:
        hashes = Hashes(words, seed) if len(words) else None
        found = [(np.zeros(0, np.int64),) * 3]
        for nodes, bounds, applied in grammar.rules:
            rule, start, stop, period = _crossing(words, hashes, nodes)
            times = np.diff(bounds)[rule]
            nth = np.arange(times.sum()) - np.repeat(np.cumsum(times) - times, times)
            moved = applied[np.repeat(bounds[rule], times) + nth]
            moved = moved - np.repeat(nodes[0][rule], times)
            found.append(
                (
                    np.repeat(start, times) + moved,
                    np.repeat(stop, times) + moved,
                    np.repeat(period, times),
                )
            )
        for nodes in grammar.trees():
            found.append(_crossing(words, hashes, nodes)[1:])
        runs = _merged(*(np.concatenate(x) for x in zip(*found, strict=True)))
        if all((words[s : e - p] == words[s + p : e]).all() for s, e, p in zip(*runs, strict=True)):
            return runs
        seed += 1


def _numbered(texts: list[bytes]) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
    """The words of texts, their numbers (other ones in each text) and where texts begin."""
    parts = [t.split() for t in texts]
    bounds = np.cumsum([0, *map(len, parts)])
    numbers, used = np.empty(bounds[-1], np.int64), 0
    for k, words in enumerate(parts):
        names = {w: used + i for i, w in enumerate(dict.fromkeys(words))}
        numbers[bounds[k] : bounds[k + 1]] = np.fromiter(
            map(names.__getitem__, words), np.int64, len(words)
        )
        used += len(names)
    return parts, numbers, bounds


def runs_of(texts: list[bytes]) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """Number of words, runs (start, length, period) and words that stay, of each text."""
    parts, numbers, bounds = _numbered(texts)
    inner = np.ones(len(numbers), bool)
    inner[bounds[1:][bounds[1:] > 0] - 1] = False
    start, stop, period = find_runs(numbers, inner)
    change = np.zeros(len(numbers) + 1, np.int64)
    np.add.at(change, start + period, 1)
    np.add.at(change, stop, -1)
    gone = np.cumsum(change[:-1]) > 0
    first = np.searchsorted(start, bounds)
    for k, words in enumerate(parts):
        mine = slice(first[k], first[k + 1])
        if mine.start == mine.stop:
            yield len(words), [], b" ".join(words)
            continue
        runs = np.stack([start[mine] - bounds[k], (stop - start)[mine], period[mine]], 1)
        out = gone[bounds[k] : bounds[k + 1]]
        stays = b" ".join([w for w, g in zip(words, out.tolist(), strict=True) if not g])
        yield len(words), list(map(tuple, runs.tolist())), stays


def with_runs(docs: DataFrame, text: str = "text", name: str = "periodic") -> DataFrame:
    """``docs`` with a struct column ``name``: n_words, runs (start, length and period in words,
    sorted by start and period) and collapsed, the words that no run repeats after its first
    period, joined by one space."""

    @F.arrow_udf(RESULT)
    def detect(bodies: pa.Array) -> pa.Array:
        counts, sizes, runs, stays = [], [0], [], []
        texts, held = [], 0

        def work() -> None:
            for n, found, left in runs_of(texts):
                counts.append(n)
                sizes.append(len(found))
                runs.extend(found)
                stays.append(left.decode())

        for body in bodies:
            body = (body.as_py() or "").encode()
            if texts and held + len(body) > TOGETHER:
                work()
                texts, held = [], 0
            texts.append(body)
            held += len(body)
        work()
        columns = zip(*runs, strict=True) if runs else ((), (), ())
        triples = pa.StructArray.from_arrays(
            [pa.array(c, pa.int64()) for c in columns], ["start", "length", "period"]
        )
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(sizes), pa.int32()), triples)
        return pa.StructArray.from_arrays(
            [pa.array(counts, pa.int64()), lists, pa.array(stays, pa.string())],
            ["n_words", "runs", "collapsed"],
        )

    kept = [exact(c) for c in docs.columns]
    body = exact(text).cast("string")
    return docs.select(*kept, detect(body).alias(free_name(docs, name)))
