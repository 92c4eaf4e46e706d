"""Periodic runs of words in a text, by a suffix automaton with link-cut access.

A run is a stretch of consecutive words whose smallest period is ``q`` (words ``q`` apart are the
same), at least ``max(least, times * q)`` words long, that no neighbouring word extends.

Words are appended one by one to a suffix automaton. The states that spell the suffixes of the
text so far form a path of its link tree. A link-cut tree keeps that tree in path segments, each
coloured by the last position where its strings ended. Appending word ``i`` accesses the path of
the new state and recolours it segment by segment; a segment whose deepest string has ``length``
words and ended last at ``e`` shows that the last ``length`` words occurred ``d = i - e`` words
before. With ``d <= length`` these are squares of period ``d`` (the smallest one, since a smaller
period would have left a later colour), and the stretch that begins ``length + d`` words back can't
be extended to the left. It is a whole run as soon as the next word differs from the one ``d``
before it; each run is reported there, once.

Before that, stretches that can't hold a run are left out, exactly: a run of ``q`` periods at
least ``times`` over repeats every window of ``least - least / times`` words at distance ``q``, so
that it lies within words covered by windows that have an equal one within a third (``1 / times``)
of their stretch. Windows are compared by hashes; a collision only leaves more for the automaton.

Texts are rows of their own: nothing is shuffled, repeated rows and ids are reported each. Null,
empty and wordless texts have no words and no runs. Memory follows the longest repeated stretch of
one text. Columns other than id and text are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST = 24
TIMES = 3
#: Text that is returned at a time.
SLICE_BYTES = 4 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
_FAR = np.iinfo(np.int64).max

Run = tuple[int, int, int]


def squares_to_runs(words: list[int], least: int = LEAST, times: int = TIMES) -> list[Run]:
    """All runs ``(start, length, period)`` of a sequence of word numbers, by place of their end."""
    n = len(words)
    found: list[Run] = []
    # the automaton: transitions, suffix link and longest string of each state
    goes: list[dict[int, int]] = [{}]
    link, longest = [-1], [0]
    # the link-cut tree: one splay tree per path segment, ordered by depth; ``up`` of its root
    # names the state above the segment; the root holds the segment's colour
    left, right, up, colour = [-1], [-1], [-1], [-1]

    def state(length: int, steps: dict[int, int]) -> int:
        goes.append(steps)
        longest.append(length)
        for column in (link, left, right, up, colour):
            column.append(-1)
        return len(goes) - 1

    def rotate(x: int) -> None:
        p = up[x]
        g = up[p]
        if left[p] == x:
            b = left[p] = right[x]
            right[x] = p
        else:
            b = right[p] = left[x]
            left[x] = p
        if b >= 0:
            up[b] = p
        up[p], up[x], colour[x] = x, g, colour[p]
        if g >= 0:
            if left[g] == p:
                left[g] = x
            elif right[g] == p:
                right[g] = x

    def splay(x: int) -> None:
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = up[p]
            if g >= 0 and (left[g] == p or right[g] == p):
                rotate(p if (left[g] == p) == (left[p] == x) else x)
            rotate(x)

    last = 0
    for i, word in enumerate(words):
        new = state(longest[last] + 1, {})
        p = last
        while p >= 0 and word not in goes[p]:
            goes[p][word] = new
            p = link[p]
        above = 0
        if p >= 0:
            q = above = goes[p][word]
            if longest[p] + 1 < longest[q]:
                above = state(longest[p] + 1, dict(goes[q]))
                link[above], link[q] = link[q], above
                while p >= 0 and goes[p].get(word) == q:
                    goes[p][word] = above
                    p = link[p]
                # the copy stands right above ``q``, in its segment
                splay(q)
                left[above] = left[q]
                if left[q] >= 0:
                    up[left[q]] = above
                left[q], up[above] = above, q
        link[new] = up[new] = above
        last = new

        below, v = -1, new
        while v >= 0:
            splay(v)
            end, reach = colour[v], longest[v]
            if 0 <= i - end <= reach and end >= 0:
                d = i - end
                if (i + 1 == n or words[i + 1] != words[i + 1 - d]) and reach + d >= max(least, times * d):
                    found.append((end - reach + 1, reach + d, d))
            if right[v] >= 0:
                colour[right[v]] = end  # the deeper rest keeps its colour
            right[v] = below
            below, v = v, up[v]
        colour[below] = i
    return found


def _stretches(marked: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the stretches of marked places."""
    edge = np.diff(np.concatenate(([0], marked.view(np.int8), [0])))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def repeated_stretches(codes: np.ndarray, least: int = LEAST, times: int = TIMES) -> list[tuple[int, int]]:
    """Stretches ``[start, end)`` outside of which no word belongs to a run."""
    n, width = len(codes), 1
    if n < least:
        return []
    with np.errstate(over="ignore"):
        h = (codes.astype(np.uint64) + np.uint64(1)) * _MIX
        while 2 * width <= least - least // times:
            a, b = h[: len(h) - width], h[width:]
            h = (a ^ (a >> np.uint64(29))) * _MIX + (b ^ (b >> np.uint64(32)))
            width *= 2
    order = np.argsort(h, kind="stable")
    same = np.flatnonzero(h[order[1:]] == h[order[:-1]])
    if not len(same):
        return []
    nearest = np.full(len(h), _FAR)
    one, two = order[same], order[same + 1]
    nearest[two] = two - one
    nearest[one] = np.minimum(nearest[one], two - one)
    keep = nearest < _FAR
    # any number of rounds is right: each leaves out only what can't belong to a run
    for _ in range(4):
        steps = np.zeros(n + 1, np.int64)
        at = np.flatnonzero(keep)
        steps[at] += 1
        np.add.at(steps, at + width, -1)
        starts, ends = _stretches(np.cumsum(steps[:n]) > 0)
        long = np.repeat(ends - starts, ends - starts)
        room = np.zeros(n, np.int64)
        room[np.repeat(starts - np.concatenate(([0], np.cumsum(ends - starts)[:-1])), ends - starts) + np.arange(len(long))] = long
        tighter = keep & (nearest <= room[: len(h)] // times)
        if (tighter == keep).all():
            break
        keep = tighter
        if not keep.any():
            return []
    return [(a, b) for a, b in zip(starts.tolist(), ends.tolist(), strict=True) if b - a >= least]


def find_runs(words: list, least: int = LEAST, times: int = TIMES) -> list[Run]:
    """All runs ``(start, length, period)`` of a list of words, by start, then period."""
    if len(words) < least:
        return []
    number = dict.fromkeys(words)
    for k, word in enumerate(number):
        number[word] = k
    codes = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    runs = [
        (start + s, length, period)
        for start, end in repeated_stretches(codes, least, times)
        for s, length, period in squares_to_runs(codes[start:end].tolist(), least, times)
    ]
    return sorted(runs, key=lambda r: (r[0], r[2]))


def leading(runs: list[Run]) -> Run | None:
    """The run with the greatest exponent; ties: smallest start, then period."""
    return max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)


def collapse(words: list, runs: list[Run]) -> list:
    """The words without those that a run contains after its first period."""
    if not runs:
        return words
    drop = np.zeros(len(words), bool)
    for start, length, period in runs:
        drop[start + period : start + length] = True
    return [w for w, gone in zip(words, drop.tolist(), strict=True) if not gone]


_RUN = T.StructType(
    [T.StructField("start", T.LongType()), T.StructField("length", T.LongType()), T.StructField("period", T.LongType())]
)


def runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", least: int = LEAST, times: int = TIMES
) -> DataFrame:
    """Per document: id, ``n_words``, ``runs`` (by start, then period), ``leading`` (that with the
    greatest length / period, null without runs) and ``collapsed`` (kept words joined by a space)."""
    slim = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    schema = T.StructType(
        [
            T.StructField("id", slim.schema["id"].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("runs", T.ArrayType(_RUN)),
            T.StructField("leading", _RUN),
            T.StructField("collapsed", T.StringType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        target = to_arrow_schema(schema)
        kind = target.field("leading").type

        def named(r: Run | None):
            return None if r is None else dict(zip(("start", "length", "period"), r, strict=True))

        def rows(ids: pa.Array, counts: list, found: list, kept: list) -> pa.RecordBatch:
            columns = [
                ids.cast(target.field("id").type),
                pa.array(counts, pa.int64()),
                pa.array([[named(r) for r in own] for own in found], target.field("runs").type),
                pa.array([named(leading(own)) for own in found], kind),
                pa.array(kept, pa.binary()).cast(pa.string()),
            ]
            return pa.RecordBatch.from_arrays(columns, schema=target)

        for batch in batches:
            texts = batch.column("text").cast(pa.binary())
            at, size, counts, found, kept = 0, 0, [], [], []
            for k in range(batch.num_rows):
                words = (texts[k].as_py() or b"").split()
                own = find_runs(words, least, times)
                counts.append(len(words))
                found.append(own)
                kept.append(b" ".join(collapse(words, own)))
                size += len(kept[-1])
                if size >= SLICE_BYTES:
                    yield rows(batch.column("id").slice(at, k + 1 - at), counts, found, kept)
                    at, size, counts, found, kept = k + 1, 0, [], [], []
            if counts:
                yield rows(batch.column("id").slice(at), counts, found, kept)

    return slim.mapInArrow(run, schema).withColumnRenamed("id", id_col)
