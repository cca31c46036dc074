"""Words that differ by one code point, and the common spelling of rare ones.

Two words are near if one insertion, deletion or replacement turns one into the other: then the
length of their common prefix plus that of their common suffix reaches the longer word's
length minus one. Words are rows of padded code-point matrices, once from the left and once
from the right, and block pairs of rows are compared densely, column by column.

Which blocks meet: the longer one's length L bounds prefix or suffix from below, one of them
has L // 2 code points. So words of length L and L - 1 are bucketed by their first and by
their last L // 2 code points. A bucket above `TILE` rows is cut into tiles by hash, and every
pair of its tiles is a group of its own that any task can take; no bucket is gathered, and
only near pairs come out. A pair that both its buckets hold is reported by the prefix alone.

`variant_forms` reduces the pairs to one row per word with partial aggregates; a word has few
near words, since these differ in one of its places. `roots` follows forms by pointer doubling,
one written table per step.

Defined results: null words are left out; words are told apart by their code points; an empty
table gives an empty table; ties between near words of equal count go to the smallest in
code-point order; a word whose form has no form is that form's root, and a word without a
form its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripweave.functions.numbers import exact
from tripweave.llm.frames import saved

#: Letters that make up words here.
LETTERS = "a-z\\u00C0-\\u00FF"
#: Rows of a tile, code points of a tile, and pairs that are compared at once.
TILE = 512
TILE_POINTS = 1 << 20
PAIRS = 1 << 19
#: A form is this many times as frequent as its variant at least.
COMMONER = 5

GROUP = ["len", "side", "part", "i", "j"]
NEAR = "word string, n bigint, other string, other_n bigint"


def words_of(text: Column, least: int) -> Column:
    """Maximal runs of letters with ``least`` code points or more, A-Z in lower case."""
    upper, lower = (bytes(range(a, a + 26)).decode() for a in (65, 97))
    pattern = F.lit(f"[{LETTERS}]{{{least},}}")
    return F.regexp_extract_all(F.translate(text, upper, lower), pattern, F.lit(0))


def count_words(words: DataFrame, word: str = "word", least: int = 6, times: int = 5) -> DataFrame:
    """(word, n) of the words with ``least`` code points and ``times`` occurrences or more."""
    w = exact(word)
    counts = words.filter(F.char_length(w) >= least).groupBy(w.alias("word"))
    return counts.agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= times)


def _bucketed(counts: DataFrame) -> DataFrame:
    """Each word under four keys: as the longer and as the shorter one, by prefix and suffix."""
    size = F.char_length("word")

    def key(longer: int, side: int) -> Column:
        length = size + (1 - longer)
        half = F.floor(length / 2).cast("int")
        part = F.col("word").substr(F.lit(1), half) if side == 0 else F.right("word", half)
        return F.struct(
            length.alias("len"),
            F.lit(side).alias("side"),
            part.alias("part"),
            F.lit(longer).alias("longer"),
        )

    keys = F.array(*[key(longer, side) for longer in (1, 0) for side in (0, 1)])
    return counts.select("word", "n", F.inline(keys))


def _tiled(rows: DataFrame) -> DataFrame:
    """The rows under every pair of tiles they belong to."""
    bucket = ["len", "side", "part"]
    room = F.greatest(F.lit(2), F.least(F.lit(TILE), F.floor(F.lit(TILE_POINTS) / F.col("len"))))
    large = (
        rows.groupBy(*bucket)
        .agg(F.count(F.lit(1)).alias("m"))
        .filter(F.col("m") > room)
        .select(*bucket, F.ceil(F.col("m") / room).cast("int").alias("tiles"))
    )
    tiles = F.coalesce("tiles", F.lit(1))
    cut = rows.join(large, bucket, "left").select(
        *rows.columns, tiles.alias("tiles"), F.pmod(F.xxhash64("word"), tiles).cast("int").alias("tile")
    )
    other = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    return cut.select("*", other.alias("other")).select(
        *rows.columns,
        "tile",
        F.least("tile", "other").alias("i"),
        F.greatest("tile", "other").alias("j"),
    )


def code_points(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The words as rows of code points, from the left and from the right, and their lengths."""
    sizes = np.array([len(w) for w in words])
    points = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
    shape = (len(words), int(sizes.max(initial=0)))
    left, right = np.zeros(shape, np.uint32), np.zeros(shape, np.uint32)
    column = np.arange(shape[1])
    filled = column < sizes[:, None]
    left[filled] = points
    nth = np.arange(len(points)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    row = np.repeat(np.arange(len(words)), sizes)
    right[row, np.repeat(sizes, sizes) - 1 - nth] = points
    return left, right, sizes


def _common(points: np.ndarray, a: np.ndarray, b: np.ndarray, most: np.ndarray) -> np.ndarray:
    """How many first columns of rows ``a`` and ``b`` agree, up to ``most``."""
    size = np.zeros(len(a), np.int64)
    open_ = np.arange(len(a))
    for column in points.T:
        open_ = open_[column[a[open_]] == column[b[open_]]]
        open_ = open_[size[open_] < most[open_]]
        if not len(open_):
            break
        size[open_] += 1
    return size


def near_rows(words: list[str], a: np.ndarray, b: np.ndarray, matrices=None):
    """Which pairs of rows are one edit apart, and the length of their common prefix."""
    left, right, sizes = matrices or code_points(words)
    short, long = np.minimum(sizes[a], sizes[b]), np.maximum(sizes[a], sizes[b])
    prefix = _common(left, a, b, short)
    suffix = _common(right, a, b, short)
    return (prefix + suffix >= long - 1) & (long - short <= 1), prefix


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Near pairs of rows (group, longer, tile, word, n) sorted by group."""

    def work(rows: pa.Table) -> Iterator[pa.RecordBatch]:
        words = rows.column("word").to_pylist()
        count, longer, tile, length, side, i, j = (
            rows.column(c).to_numpy() for c in ("n", "longer", "tile", "len", "side", "i", "j")
        )
        group = rows.column("group").to_numpy()
        ends = np.searchsorted(group, group, side="right")
        matrices = code_points(words)
        partners = ends - np.arange(len(words)) - 1
        total = np.concatenate([[0], np.cumsum(partners)])
        first = 0
        while first < len(words):
            last = int(np.searchsorted(total, total[first] + PAIRS, side="right")) - 1
            last = min(max(last, first + 1), len(words))
            a = np.repeat(np.arange(first, last), partners[first:last])
            b = a + 1 + np.arange(len(a)) - np.repeat(total[first:last] - total[first], partners[first:last])
            meet = (longer[a] + longer[b] > 0) & ((i[a] == j[a]) | (tile[a] != tile[b]))
            a, b = a[meet], b[meet]
            near, prefix = near_rows(words, a, b, matrices)
            near &= (side[a] == 0) | (prefix < length[a] // 2)
            a, b = a[near], b[near]
            x, y = np.concatenate([a, b]), np.concatenate([b, a])
            if len(x):
                column = rows.column("word").combine_chunks()
                yield pa.RecordBatch.from_arrays(
                    [column.take(pa.array(x)), pa.array(count[x]), column.take(pa.array(y)), pa.array(count[y])],
                    ["word", "n", "other", "other_n"],
                )
            first = last

    held, points, last, number = [], 0, None, 0
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = list(zip(*(batch.column(c).to_pylist() for c in GROUP), strict=True))
        group = np.empty(len(keys), np.int64)
        for k, key in enumerate(keys):
            if key != last:
                number, last = number + 1, key
            group[k] = number
        batch = batch.append_column("group", pa.array(group))
        # whole groups go together; a group ends in a later batch at the earliest
        cuts = np.flatnonzero(np.diff(group, prepend=group[0] - 1 if not held else held[-1][1]))
        first = 0
        for cut in (*cuts.tolist(), len(keys)):
            if cut > first:
                part = batch.slice(first, cut - first)
                held.append((part, int(group[cut - 1])))
                points += part.num_rows * (keys[first][0] + 1)
            if cut < len(keys) and points > TILE_POINTS:
                yield from work(pa.Table.from_batches([p for p, _ in held]).combine_chunks())
                held, points = [], 0
            first = cut
    if held:
        yield from work(pa.Table.from_batches([p for p, _ in held]).combine_chunks())


def near_pairs(counts: DataFrame) -> DataFrame:
    """(word, n, other, other_n) of all near words in ``counts`` (word, n), in both directions."""
    rows = _tiled(_bucketed(counts.filter(F.col("word").isNotNull())))
    return rows.repartition(*GROUP).sortWithinPartitions(*GROUP).mapInArrow(_compared, NEAR)


def variant_forms(counts: DataFrame, commoner: int = COMMONER) -> DataFrame:
    """(word, n, n_near, form, form_n) of each word in ``counts`` (word, n).

    The form is the near word with the largest count if that is ``commoner`` times the
    word's own at least.
    """
    best = F.min(F.struct((-F.col("other_n")).alias("n"), F.col("other").alias("word")))
    near = near_pairs(counts).groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), best.alias("best")
    )
    most = -F.col("best.n")
    common = most >= commoner * F.col("n")
    return counts.filter(F.col("word").isNotNull()).join(near, "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(common, F.col("best.word")).alias("form"),
        F.when(common, most).alias("form_n"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) of the words in ``forms`` (word, form) that have a form.

    Each step doubles the way that is known. Counts grow along it, so steps are few.
    """
    ahead = saved(
        forms.filter(F.col("form").isNotNull()).select("word", F.col("form").alias("root")),
        "spelling-roots",
    )
    while True:
        on = ahead.select(F.col("word").alias("root"), F.col("root").alias("next"))
        far = saved(ahead.join(on, "root", "left").select("word", "root", "next"), "spelling-roots")
        if far.filter(F.col("next").isNotNull()).isEmpty():
            return far.select("word", "root")
        ahead = far.select("word", F.coalesce("next", "root").alias("root"))


def group_variants(counts: DataFrame, commoner: int = COMMONER) -> DataFrame:
    """(word, n, n_near, form, form_n, root) of each word in ``counts`` (word, n)."""
    forms = saved(variant_forms(saved(counts, "spelling-words"), commoner), "spelling-forms")
    return forms.join(roots(forms), "word", "left").withColumn("root", F.coalesce("root", "word"))
