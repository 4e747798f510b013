"""Line dedup by a segment-partition edit join.

A line within ``edits`` of another keeps one of edits + 1 segments unchanged. Segments are indexed by length, place
and hash; a line probes the index of its own and shorter lengths with the few substrings that an alignment of at most
that many edits allows, and only lines whose letters differ that little are paired. What meets is verified by a banded bit-parallel edit distance over whole batches.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from statlab.llm.common import LOWEST, _BASE, handing_back, mix64, row_names, slices
from statlab.session import stage

#: Edits within which lines are alike, and the length (code points) from which lines are compared at all.
EDITS, SHORTEST = 2, 80
#: Letters between the places at which the beginnings of lines are summed up.
STEP = 8


def segments(length: np.ndarray, edits: int) -> list[tuple[np.ndarray, np.ndarray]]:
    """Start and length of each of the edits + 1 nearly equal segments; the later ones are the longer."""
    parts = edits + 1
    short, longer = length // parts, length % parts
    found = []
    for i in range(parts):
        extra = np.maximum(0, i - (parts - longer))
        found.append((i * short + extra, short + (i >= parts - longer)))
    return found


def probes(length: np.ndarray, edits: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per difference in length and segment the starts at which a line may hold the segment of a shorter line.

    Before the segment, at most its number of edits may have shifted it; behind it, at most those that are left.
    """
    for less in range(edits + 1):
        for i, (start, size) in enumerate(segments(length - less, edits)):
            low, high = max(-i, less - (edits - i)), min(i, less + (edits - i))
            for shift in range(low, high + 1):
                yield less, i, start + shift, size


def _mixed(points: np.ndarray) -> np.ndarray:
    return mix64(points.astype(np.uint64) + np.uint64(1))


def _letter(points: np.ndarray) -> np.ndarray:
    """16 to the power of a code point's class."""
    return np.uint64(1) << mix64(points.astype(np.uint64)) % np.uint64(15) * np.uint64(4)


class Sums:
    """Running sums over code points. A task keeps what they are made of: powers, and the values of the first 2**16 code points."""

    def __init__(self):
        low = np.arange(1 << 16)
        self.values = {made: made(low) for made in (_mixed, _letter)}
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def _of(self, points: np.ndarray, made: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        table = self.values[made]
        high = np.flatnonzero(points >= len(table))
        if not len(high):
            return table[points]
        found = table[np.minimum(points, len(table) - 1)]
        found[high] = made(points[high])
        return found

    def hashes(self, points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Running sums of a polynomial hash over code points, and the inverse powers that cut substrings out."""
        n = len(points)
        if len(self.up) <= n:
            self.up, self.down = (np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, dtype=np.uint64)])) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
        sums = np.zeros(n + 1, dtype=np.uint64)
        np.cumsum(self._of(points, _mixed) * self.up[:n], out=sums[1:])
        return sums, self.down

    def letters(self, points: np.ndarray) -> np.ndarray:
        """Running sums in which a letter of class c counts 16 to the power of c, modulo 2**60."""
        sums = np.zeros(len(points) + 1, dtype=np.uint64)
        np.cumsum(self._of(points, _letter), out=sums[1:])
        return sums


def _lines(batch: pa.RecordBatch, shortest: int):
    """The code points of all texts end to end, and of each long enough line: text, line number, start and length."""
    texts = [t or "" for t in batch.column("text").to_pylist()]
    points = np.frombuffer("\n".join(texts).encode("utf-32-le"), dtype=np.uint32)
    first = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])])
    breaks = np.flatnonzero(points == 10)
    starts, ends = np.concatenate([[0], breaks + 1]), np.concatenate([breaks, [len(points)]])
    text = np.searchsorted(first, starts, side="right") - 1
    number = np.arange(len(starts)) - np.searchsorted(starts, first)[text]
    some = (ends - starts >= shortest) & (text < len(texts))
    return points, text[some], number[some], starts[some], (ends - starts)[some]


def _near_sums(a: Column, b: Column, edits: int) -> Column:
    """An edit changes the letter sum of a line, and of its first so many letters, by at most two powers of 16. A
    difference of more non-zero signed digits than that is of lines farther apart; one more is allowed for the modulus."""
    apart = a - b
    return F.bit_count(apart.bitwiseXOR(apart * 3)) <= 2 * edits + 1


def _may_be_near(edits: int) -> Column:
    """Whether the sums of two lines, and those of their beginnings as far as both go, allow so few edits."""
    begun = F.forall(F.zip_with("a_begun", "b_begun", lambda a, b: F.coalesce(_near_sums(a, b, edits), F.lit(True))), lambda x: x)
    return _near_sums(F.col("a_sum"), F.col("b_sum"), edits) & begun


def _line_names(sums: np.ndarray, down: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    return mix64((sums[start + length] - sums[start]) * down[start] + length.astype(np.uint64)).view(np.int64)


def _hashed(sums: np.ndarray, down: np.ndarray, start: np.ndarray, length: np.ndarray, less: int, i: int, at: np.ndarray, size: np.ndarray, edits: int) -> tuple[np.ndarray, np.ndarray]:
    """The key of a substring as segment ``i`` of lines ``less`` shorter, and whether it lies inside the line."""
    inside = (at >= 0) & (at + size <= length)
    a, size = np.where(inside, start + at, start), np.where(inside, size, 0)
    part = (sums[a + size] - sums[a]) * down[a]
    return mix64(part + mix64(((length - less) * (edits + 1) + i).astype(np.uint64))).view(np.int64), inside


def _letters(sums: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    return ((sums[start + length] - sums[start]) & np.uint64((1 << 60) - 1)).view(np.int64)


def _occurrences(shortest: int, edits: int):
    """Every line with its name, the sum of its letters, and the keys of its segments."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = Sums()
        for batch in slices(batches, 1 << 20):
            points, text, number, start, length = _lines(batch, shortest)
            sums, down = running.hashes(points)
            keys = np.stack([_hashed(sums, down, start, length, 0, i, s, n, edits)[0] for i, (s, n) in enumerate(segments(length, edits))], axis=1)
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(start) + 1, dtype=np.int32) * (edits + 1)), pa.array(keys.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c).take(pa.array(text)) for c in ("doc", "row")), pa.array(number.astype(np.int32)),
                 pa.array(_line_names(sums, down, start, length)), pa.array(_letters(running.letters(points), start, length)), lists],
                ["doc", "row", "line", "lid", "letters", "keys"])
    return made


def _probes(shortest: int, edits: int):
    """A row per probe of every line that is the first of its kind in the batch."""
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        running = Sums()
        for batch in slices(batches, 1 << 20):
            points, _, _, start, length = _lines(batch, shortest)
            sums, down = running.hashes(points)
            names, one = np.unique(_line_names(sums, down, start, length), return_index=True)
            start, length, found = start[one], length[one], []
            own = _letters(running.letters(points), start, length)
            for less, i, at, size in probes(length, edits):
                key, inside = _hashed(sums, down, start, length, less, i, at, size, edits)
                found.append((key[inside], names[inside], own[inside], np.full(int(inside.sum()), less > 0)))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found)], ["key", "lid", "letters", "shorter"])
    return made


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        press = zstandard.ZstdCompressor(level=3)
        texts = [press.compress((t or "").encode()) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column("doc"), batch.column("row"), pa.array(texts, pa.binary())], ["doc", "row", "packed"])


def _contents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The lines asked for, by number, of packed texts, and the letter sums of every STEP letters of their beginnings."""
    open_, running = zstandard.ZstdDecompressor(), Sums()
    for whole in batches:
        for start in range(0, whole.num_rows, 256):
            names, lines = [], []
            for row in whole.slice(start, 256).to_pylist():
                text = open_.decompress(row["packed"]).decode().split("\n")
                for asked in row["asked"]:
                    if asked["line"] < len(text):
                        names.append(asked["lid"])
                        lines.append(text[asked["line"]])
            points = np.frombuffer("".join(lines).encode("utf-32-le"), dtype=np.uint32)
            length = np.array([len(x) for x in lines], dtype=np.int64)
            begin = np.cumsum(length) - length
            same = _line_names(*running.hashes(points), begin, length) == np.array(names, dtype=np.int64)
            sums = running.letters(points)
            parts = length // STEP
            at = np.repeat(begin, parts) + (np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts) + 1) * STEP
            begun = ((sums[at] - sums[np.repeat(begin, parts)]) & np.uint64((1 << 60) - 1)).view(np.int64)
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(parts)]).astype(np.int32)), pa.array(begun))
            found = pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(lines, pa.string()), lists], ["lid", "content", "begun"])
            yield found.filter(pa.array(same))


def _short_distance(p: np.ndarray, q: np.ndarray) -> int:
    """The edit distance of two remainders of a few code points."""
    above = list(range(len(q) + 1))
    for i, x in enumerate(p, 1):
        row = [i]
        for j, y in enumerate(q, 1):
            row.append(min(above[j] + 1, row[-1] + 1, above[j - 1] + int(x != y)))
        above = row
    return above[-1]


def within(a: list[str], b: list[str], edits: int) -> np.ndarray:
    """Whether each pair of texts is within ``edits`` edits of code points, all pairs at once.

    Common beginnings and ends are cut off first. Then a band of 2 * edits + 1 diagonals moves along the pairs, a bit
    for each: vertical and horizontal differences are kept as bits, and the distance along the lowest diagonal, and
    from its end along the last row, as a number. Pairs that are beyond help leave the batch.
    """
    result = np.zeros(len(a), dtype=bool)
    rows, longer, shorter = [], [], []
    for i, (x, y) in enumerate(zip(a, b)):
        x, y = (x, y) if len(x) >= len(y) else (y, x)
        if len(x) - len(y) > edits:
            continue
        p = np.frombuffer(x.encode("utf-32-le"), np.uint32)
        q = np.frombuffer(y.encode("utf-32-le"), np.uint32)
        n = len(q)
        same = p[:n] == q
        head = n if same.all() else int(same.argmin())
        p, q = p[head:], q[head:]
        n = len(q)
        same = p[len(p) - n:][::-1] == q[::-1]
        tail = n if same.all() else int(same.argmin())
        p, q = p[:len(p) - tail], q[:n - tail]
        if len(q) <= edits:
            result[i] = _short_distance(p, q) <= edits
            continue
        rows.append(i)
        longer.append(p)
        shorter.append(q)
    if not rows:
        return result
    rows = np.array(rows)
    m, n = np.array([len(p) for p in longer]), np.array([len(q) for q in shorter])
    p, q = np.concatenate(longer), np.concatenate(shorter)
    at_p, at_q = np.concatenate([[0], np.cumsum(m)[:-1]]), np.concatenate([[0], np.cumsum(n)[:-1]])
    width, one = 2 * edits, np.uint64(1)
    full = np.uint64((1 << (width + 1)) - 1)
    vp, vn = np.full(len(rows), full & ~np.uint64((1 << edits) - 1)), np.zeros(len(rows), np.uint64)
    distance, horizontal = np.full(len(rows), edits), np.full(len(rows), width - 1)
    j = 0
    while len(rows):
        match = np.zeros(len(rows), np.uint64)
        letter = q[at_q + j]
        for t in range(width + 1):
            place = j - edits + t
            equal = (place >= 0) & (place < m) & (p[at_p + np.clip(place, 0, m - 1)] == letter)
            match |= equal.astype(np.uint64) << np.uint64(t)
        d0 = ((((match & vp) + vp) ^ vp) | match | vn) & full
        hp, hn = (vn | ~(d0 | vp)) & full, d0 & vp
        diagonal = j < m - edits
        along = (hp >> horizontal.astype(np.uint64) & one).astype(int) - (hn >> horizontal.astype(np.uint64) & one).astype(int)
        distance = distance + np.where(diagonal, 1 - (d0 >> np.uint64(width) & one).astype(int), along)
        horizontal = np.where(diagonal, horizontal, horizontal - 1)
        shifted = d0 >> one
        vp, vn = (hn | ~(shifted | hp)) & full, shifted & hp
        j += 1
        over = n == j
        result[rows[over]] = distance[over] <= edits
        stay = ~over & (distance <= 2 * edits + np.maximum(n - m, 0))
        if not stay.all():
            rows, m, n, at_p, at_q = rows[stay], m[stay], n[stay], at_p[stay], at_q[stay]
            vp, vn, distance, horizontal = vp[stay], vn[stay], distance[stay], horizontal[stay]
    return result


def _verified(edits: int):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, 1 << 21, "x"):
            alike = within(batch.column("x").to_pylist(), batch.column("y").to_pylist(), edits)
            yield pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b")], ["a", "b"]).filter(pa.array(alike))
    return made


def _place() -> Column:
    return F.struct("doc", "row", "line")


def _earlier_neighbours(asked: DataFrame, index: DataFrame, classes: DataFrame, contents: Callable[[DataFrame], DataFrame], edits: int) -> DataFrame:
    """``lid``: the lines that have an earlier one within ``edits`` edits. ``contents`` reads lines by ``lid, first``.

    A line needs only one such neighbour. So the lines of each list are first compared with two of it, the earliest and
    the one whose lists are longest, which in a group of variants is what they are variants of; a list asks twice as many
    questions as it has lines. Lines for which that found no neighbour are then compared with all earlier ones of their lists.
    """
    # Most keys are met by one line alone; only the others go on.
    alone = index.groupBy("key").agg(F.min("b").alias("low"), F.max("b").alias("high"))
    probing = asked.join(alone, "key").where((F.col("low") != F.col("a")) | (F.col("high") != F.col("a")))
    probing = stage(probing.select("key", F.col("a").alias("lid"), F.col("a_sum").alias("sum"), "shorter"), "probing")
    keys = stage(probing.select("key").distinct(), "live-keys")
    held = stage(index.join(keys, "key", "left_semi").select("key", F.col("b").alias("lid"), F.col("b_sum").alias("sum")), "held")
    members = probing.select("key", "lid", F.lit(False).alias("held")).unionAll(held.select("key", "lid", F.lit(True).alias("held")))
    sizes = stage(members.groupBy("key").agg(F.count("*").alias("size")), "list-sizes")
    met = members.select("key", "lid").distinct().join(sizes, "key").groupBy("lid").agg(F.sum("size").alias("met"))
    known = stage(met.join(classes.select("lid", "first"), "lid"), "known-lines")
    texts = stage(contents(known.select("lid", "first")), "contents")
    known = known.join(texts.select("lid", "begun"), "lid")
    probing, held = (stage(side.join(known, "lid"), "placed") for side in (probing, held))

    def pairs(left: DataFrame, right: DataFrame) -> DataFrame:
        """Pairs across a list of which the one from ``right`` is earlier; ``a`` is the later line."""
        one = left.select("key", F.col("lid").alias("a"), F.col("sum").alias("a_sum"), F.col("begun").alias("a_begun"), F.col("first").alias("a_first"))
        two = right.select("key", F.col("lid").alias("b"), F.col("sum").alias("b_sum"), F.col("begun").alias("b_begun"), F.col("first").alias("b_first"))
        return one.join(two, "key").where((F.col("b_first") < F.col("a_first")) & _may_be_near(edits)).select("a", "b")

    def heads(side: DataFrame) -> DataFrame:
        each = F.struct("lid", "sum", "begun", "first")
        best = side.groupBy("key").agg(F.min_by(each, "first").alias("early"), F.max_by(each, F.struct("met", "lid")).alias("central"))
        return stage(best.select("key", F.explode(F.array_distinct(F.array("early", "central"))).alias("h")).select("key", "h.*"), "heads")

    def compare(met: DataFrame) -> DataFrame:
        pairs = met.join(texts.select(F.col("lid").alias("a"), F.col("content").alias("x")), "a")
        pairs = pairs.join(texts.select(F.col("lid").alias("b"), F.col("content").alias("y")), "b").select("a", "b", "x", "y")
        return pairs.mapInArrow(handing_back(_verified(edits)), "a long, b long")

    # Lines of one length probe each other, so one direction is enough for them; a longer earlier one probes a later one.
    longer = probing.where("shorter")
    first_asked = stage(pairs(probing, heads(held)).unionAll(pairs(held, heads(longer))).distinct(), "first-asked")
    decided = stage(compare(first_asked).select(F.col("a").alias("lid")).distinct(), "decided")
    open_probing, open_held = (stage(side.join(decided, "lid", "left_anti"), "open") for side in (probing, held))
    rest = pairs(open_probing, held).unionAll(pairs(open_held, longer)).distinct()
    rest = stage(rest.join(first_asked, ["a", "b"], "left_anti"), "rest-asked")
    return decided.unionAll(compare(rest).select(F.col("a").alias("lid")).distinct())


def repeated_lines(docs: DataFrame, edits: int = EDITS, shortest: int = SHORTEST) -> DataFrame:
    """``doc_id, row, dropped``: the numbers (from 0) of each document's lines that repeat an earlier line.

    A line repeats an earlier one, by document id and line number, when it is within ``edits`` edits of it. Lines of
    fewer than ``shortest`` code points are never compared. Equal lines are one class and are joined once; candidates
    meet by hashes, and only their lines travel. A null text has one empty line; null ids come first, and texts that
    share an id follow each other in the order of their hashes, ``row``. Rows equal in id and text count as one.
    Documents without repeats are not returned.
    """
    known = docs.select(*row_names(), "text")
    lines = stage(known.mapInArrow(handing_back(_occurrences(shortest, edits)), "doc long, row long, line int, lid long, letters long, keys array<long>"), "lines")
    same = [F.first(c).alias(c) for c in ("letters", "keys")]
    classes = stage(lines.groupBy("lid").agg(F.min(_place()).alias("first"), F.count("*").alias("n"), *same), "classes")
    index = classes.select(F.explode("keys").alias("key"), F.col("lid").alias("b"), F.col("letters").alias("b_sum"))
    asked = known.mapInArrow(handing_back(_probes(shortest, edits)), "key long, lid long, letters long, shorter boolean").toDF("key", "a", "a_sum", "shorter")
    packed = known.mapInArrow(handing_back(_packed), "doc long, row long, packed binary")

    def contents(wanted: DataFrame) -> DataFrame:
        owners = wanted.select("lid", "first.doc", "first.row", "first.line").groupBy("doc", "row").agg(F.collect_list(F.struct("line", "lid")).alias("asked"))
        # As many owners as there are candidates, which grow with the table: merged at every size, never sent to all tasks.
        texts = packed.join(stage(owners, "owners").hint("merge"), ["doc", "row"]).mapInArrow(handing_back(_contents), "lid long, content string, begun array<long>")
        return texts.groupBy("lid").agg(F.first("content").alias("content"), F.first("begun").alias("begun"))

    later = stage(_earlier_neighbours(asked, index, classes, contents, edits).distinct().withColumn("later", F.lit(True)), "later")
    judged = classes.select("lid", "first", "n").join(later, "lid", "left").withColumn("later", F.coalesce("later", F.lit(False)))
    judged = stage(judged.where("later OR n > 1").select("lid", "later", "first"), "judged")
    out = lines.select("doc", "row", "line", "lid").join(judged, "lid").where(F.col("later") | (_place() != F.col("first")))
    out = out.groupBy("doc", "row").agg(F.sort_array(F.collect_set("line")).alias("dropped"))
    return out.select(F.nullif(F.col("doc"), F.lit(LOWEST)).alias("doc_id"), "row", "dropped")


def _dropped(docs: DataFrame) -> DataFrame:
    """The repeated lines as ``_dropped``, by ``_doc`` and ``_row``."""
    found = repeated_lines(docs).select(F.coalesce("doc_id", F.lit(LOWEST)).alias("_doc"), F.col("row").alias("_row"), F.col("dropped").alias("_dropped"))
    return stage(found, "repeated")


def line_dedup(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, dropped`` of every document."""
    n_lines = F.size(F.split(F.coalesce("text", F.lit("")), "\n"))
    dropped = F.coalesce("_dropped", F.array().cast("array<int>"))
    rows = docs.select("doc_id", n_lines.alias("n_lines"), *row_names())
    joined = rows.join(_dropped(docs), (F.col("doc") == F.col("_doc")) & (F.col("row") == F.col("_row")), "left")
    return joined.select("doc_id", "n_lines", F.size(dropped).alias("n_dropped"), dropped.alias("dropped"))


def without_repeats(docs: DataFrame) -> DataFrame:
    """The documents without their repeated lines; those of which nothing but blank lines is left go as well.

    Documents without repeats stay as they are, null and empty ones too; the columns are kept. ``n_chars`` is not
    counted again.
    """
    doc, row = row_names()
    joined = docs.join(_dropped(docs).hint("merge"), (doc == F.col("_doc")) & (row == F.col("_row")), "left")
    left = F.filter(F.split("text", "\n"), lambda x, i: ~F.array_contains(F.col("_dropped"), i))
    text = F.when(F.col("_dropped").isNull(), F.col("text")).otherwise(F.array_join(left, "\n"))
    kept = joined.withColumn("text", text).where(F.col("_dropped").isNull() | F.col("text").rlike(r"\S"))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
