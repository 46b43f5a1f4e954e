"""Panes of merging session windows, as joins over a bounded arrival log.

Each element opens a window ``[t, t + gap)``; windows of one key that overlap merge, and a late
element can bridge sessions that have fired.  A window is known by its bounds: whenever an
arrival changes them the pane numbering starts anew.  Rules as in ``operators.panes``: rows
with ``wm_ts >= t + gap + lateness`` are dropped, an EARLY pane fires ``early_delay`` after its
first element (merged sessions keep the earlier deadline), ON_TIME when the watermark reaches
the window's end, and every later element is a LATE pane.

No state is replayed.  The plan follows from four facts about the positions (distinct event
times) of a key:

* *Gaps close at an arrival.*  A position is joined to its left at the least arrival in
  ``(t - gap, t)`` and to its right at the least arrival in ``(t, t + gap)``: range minima.
* *Closed sessions stay apart.*  If nothing arrives in ``(t, t + gap)`` before the watermark
  reaches ``t + gap + lateness``, nothing is ever joined across ``t``.  These cuts part a key
  into epochs.
* *Bounds after an arrival* are the nearest position at or before it whose left gap, and the
  nearest at or after it whose right gap, closes later than that arrival: ``plans.nearest``.
  The earlier of the two closings is when the window gives way to a larger one.
* *Windows are nested or apart.*  What a window has taken over from smaller ones is the sum of
  all windows inside it, a difference of two running sums in order of their bounds.

Only the early deadlines depend on one another in sequence.  They are settled per stretch of
processing time (``_settled``), all stretches at once, from the deadlines that the stretch
before leaves open, as far as they can be foretold; stretches whose start turned out different
are settled again.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.timefmt import dur_us, from_us, to_us
from eventide.operators.panes import number_panes
from eventide.plans.nearest import Maxima
from eventide.plans.scan import running_sums
from eventide.plans.spec import PaneSpec
from eventide.session import materialize

#: Later than any arrival.
NEVER = 2**62
_ORDER = "struct<a:bigint,seq:bigint,w:bigint>"
_WINDOW = ["key", "epoch", "s", "e"]


def _never() -> Column:
    return F.struct(*[F.lit(NEVER).cast("long").alias(c) for c in ("a", "seq", "w")])


def _least_arrival(positions: DataFrame, by: list[str], gap: int, ahead: bool, out: str) -> DataFrame:
    """``positions`` with ``out``: the least ``first`` in (t, t + gap), or in (t - gap, t), of the group.

    Time is cut into blocks of ``gap``, so the range lies in a position's own block and the next
    one.  Each block also gets the positions of that next block, moved by ``gap``: what is in
    range are its own positions on one side of t and the moved ones on the other.  One shuffle
    by (group, block), each range a running minimum.
    """
    t, none = F.col("t"), F.lit(None).cast(_ORDER)
    kept = [c for c in positions.columns if c not in by]
    moved = t - gap if ahead else t + gap
    own = positions.select(*by, F.floor(t / gap).alias("_block"), t.alias("_t"), F.struct(*kept).alias("_row"), F.col("first").alias(
        "_own"), none.alias("_next"))
    other = positions.select(*by, F.floor(moved / gap).alias("_block"), moved.alias("_t"), F.lit(None).cast(own.schema["_row"].dataType).alias(
        "_row"), none.alias("_own"), F.col("first").alias("_next"))
    side = Window.partitionBy(*by, "_block")
    # A moved position exactly at t is a whole gap away: it comes after the position there, whichever way the scan goes.
    tie = F.col("_row").isNull()
    up, down = (side.orderBy(o, tie).rowsBetween(Window.unboundedPreceding, -1) for o in (F.col("_t").asc(), F.col("_t").desc()))
    least = F.least(F.min("_own").over(down if ahead else up), F.min("_next").over(up if ahead else down))
    return own.unionByName(other).select(*by, "_row", least.alias(out)).where("_row IS NOT NULL").select(*by, "_row.*", out)


def _positions(rows: DataFrame, gap: int, lateness: int, bucket: int) -> DataFrame:
    """``key, epoch, number, t`` (numbered within the key) and the closings ``left``, ``right`` of the gaps on both sides."""
    at = rows.groupBy("key", "t").agg(F.min(F.struct("a", "seq", "w")).alias("first"))
    at = materialize(_least_arrival(at, ["key"], gap, True, "right"))
    cut = F.col("right").isNull() | (F.col("right.w") >= F.col("t") + gap + lateness)
    at = at.withColumn("_cut", cut.cast("long")).withColumn("_b", F.floor(F.col("t") / bucket))
    at = running_sums(at, ["key"], ["t"], "_b", {"_cuts": F.col("_cut"), "_n": F.lit(1).cast("long")})
    at = at.select("key", (F.col("_cuts") - F.col("_cut")).alias("epoch"), (F.col("_n") - 1).alias("number"), "t", "first", F.when(
        F.col("_cut") == 1, _never()).otherwise(F.col("right")).alias("right"))
    at = _least_arrival(at, ["key", "epoch"], gap, False, "left")
    # An epoch's first position never joins its left, so searches end there.
    return materialize(at.select(F.struct("key").alias("_k"), "epoch", "number", "t", F.coalesce("left", _never()).alias("left"), "right"))


def _with_bounds(rows: DataFrame, positions: DataFrame, gap: int) -> DataFrame:
    """``rows`` with ``epoch``, the window ``[s, e)`` that holds each right after its arrival, and ``dies``, when that gives way."""
    rows = materialize(rows.withColumn("_k", F.struct("key")).join(positions.select("_k", "t", "epoch", "number"), ["_k", "t"]).drop("key"))

    def closing(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}") for c in ("a", "seq", "w")], "t").alias(side)

    table = positions.select("_k", "number", closing("left"), closing("right"))
    beyond = F.struct("a", "seq")
    rows = Maxima(table, "_k", "number", "left").nearest(rows, "number", beyond, True, "_l")
    rows = Maxima(table, "_k", "number", "right").nearest(rows, "number", beyond, False, "_r")
    dies = F.least(*[F.struct(*[F.col(f"{c}.value.{x}").alias(x) for x in ("a", "seq", "w")]) for c in ("_l", "_r")])
    return rows.select("_k.key", "score", "t", "a", "seq", "w", "epoch", F.col("_l.value.t").alias("s"), (F.col("_r.value.t") + gap).alias(
        "e"), dies.alias("dies"))


def _windows(rows: DataFrame, bucket: int) -> DataFrame:
    """One row a window: ``own`` (the sum of the rows that came while it was current), ``inside`` (of the windows in it)."""
    w = materialize(rows.groupBy(*_WINDOW).agg(
        F.sum("score").alias("own"), F.sum(F.when(F.col("early"), F.col("score"))).alias("own_early"),
        F.first("dies").alias("dies")))
    zero = F.lit(0).cast("bigint")
    # Windows by start, then the larger first: those inside a window follow it, up to the first that starts at its end.
    opens = w.select(*_WINDOW, F.col("s").alias("_at"), (-F.col("e")).alias("_tie"), F.lit(True).alias("_opens"), F.col("own").alias("_v"))
    ends = w.select(*_WINDOW, F.col("e").alias("_at"), F.lit(-NEVER).cast("long").alias("_tie"), F.lit(False).alias("_opens"), zero.alias("_v"))
    both = opens.unionByName(ends).withColumn("_b", F.floor(F.col("_at") / bucket))
    sums = running_sums(both, ["key", "epoch"], ["_at", "_tie", F.col("_opens").desc()], "_b", {"_sum": F.col("_v")})
    inside = sums.groupBy(F.struct(*_WINDOW).alias("_w")).agg(F.sum(F.when(F.col("_opens"), -F.col("_sum")).otherwise(F.col("_sum"))).alias("inside"))
    return materialize(w.withColumn("_w", F.struct(*_WINDOW)).join(inside, "_w").drop("_w"))


# ------------------------------------------------------------------ early deadlines
_ENTRY = "struct<s:bigint,e:bigint,on:bigint,due:bigint,id:bigint>"
_EARLY, _ON_TIME, _OPEN = 0, 1, 2


#: Rows that come in shorter runs are taken one by one.
SHORT = 64


class _Stretch:
    """The deadline rule over one stretch of arrivals of an epoch, in order.

    ``entries``: pending panes ``[s, e, on, due, id]`` at its start.  ``fates`` collects, for the panes
    of its rows and of the entries given, ``(is_row, members, fate, due, id, on)``: fired EARLY at
    ``due``, left to ON_TIME, or still open at the end.  Memory: the pending rows.
    """

    def __init__(self, entries: list[list], delay: int, begin: int, until: int, followed: bool):
        self.pending = [(e, [[e[4]], [], []]) for e in entries]
        self.delay, self.until, self.fates = delay, until, []
        self.ahead = _Ahead(begin + delay, delay) if followed else None

    def leave(self, entry: list, members: list, fate: int) -> None:
        given, rows, runs = members
        if given:
            self.fates.append((False, [np.array(given, np.int64)], fate, entry[3], entry[4], entry[2]))
        if rows or runs:
            self.fates.append((True, [*runs, np.array(rows, np.int64)], fate, entry[3], entry[4], entry[2]))

    def step(self, a: int, seq: int, w: int, s: int, e: int, on: int) -> None:
        hit, kept = [], []
        for entry, members in self.pending:
            if entry[3] <= a and entry[3] <= entry[2]:
                self.leave(entry, members, _EARLY)
            elif w >= entry[1]:
                self.leave(entry, members, _ON_TIME)
            elif s <= entry[0] < e:
                hit.append((entry, members))
            else:
                kept.append((entry, members))
        if hit:
            entry, members = min(hit, key=lambda h: (h[0][3], h[0][4]))
            for other, more in hit:
                if other is not entry:
                    for mine, theirs in zip(members, more, strict=True):
                        mine.extend(theirs)
            entry = [s, e, on, entry[3], entry[4]]
        else:
            entry, members = [s, e, on, a + self.delay, seq], [[], [], []]
        members[1].append(seq)
        self.pending = [*kept, (entry, members)]

    def feed(self, a, seq, w, s, e, on) -> None:
        """The next rows, as arrays."""
        n = len(a)
        if self.ahead is not None:
            self.ahead.feed(a, seq)
        if n < SHORT:
            for row in zip(*[c.tolist() for c in (a, seq, w, s, e, on)], strict=True):
                self.step(*row)
            return
        # Rows that go to the window of the row before, its end not reached: one pane is pending, until it is due.
        plain = (s[1:] <= s[:-1]) & (s[:-1] < e[1:]) & (w[1:] < e[:-1])
        stops = np.append(np.flatnonzero(~plain) + 1, n)
        i = 0
        while i < n:
            if len(self.pending) == 1:
                x = self.pending[0][0]
                if s[i] <= x[0] < e[i] and w[i] < x[1]:
                    i = self.run(i, int(stops[np.searchsorted(stops, i, "right")]), a, seq, w, s, e, on)
                    continue
            self.step(*[int(c[i]) for c in (a, seq, w, s, e, on)])
            i += 1

    def run(self, i: int, stop: int, a, seq, w, s, e, on) -> int:
        """Rows ``i`` to ``stop`` of one window's arrivals, a pane at a time; returns the row after the last taken."""
        (entry, members), begin = self.pending[0], i
        while True:
            j = i + int(np.searchsorted(a[i:stop], entry[3]))
            if j > begin:
                members[2].append(seq[begin:j])
                entry = [int(s[j - 1]), int(e[j - 1]), int(on[j - 1]), entry[3], entry[4]]
            if j == stop or entry[3] > entry[2]:
                self.pending = [(entry, members)]
                if j == stop:
                    return stop
                self.step(*[int(c[j]) for c in (a, seq, w, s, e, on)])
                return j + 1
            self.leave(entry, members, _EARLY)
            entry, members = [int(s[j]), int(e[j]), int(on[j]), int(a[j]) + self.delay, int(seq[j])], [[], [], []]
            begin, i = j, j + 1

    def end(self) -> list[list]:
        """The entries left open."""
        left = []
        for entry, members in self.pending:
            fate = _fate_at_end(entry, self.until)
            self.leave(entry, members, fate)
            if fate == _OPEN:
                left.append(entry)
        return sorted(left)


def _fate_at_end(entry: list, until: int) -> int:
    return _EARLY if entry[3] <= min(entry[2], until) else _ON_TIME if entry[2] < min(entry[3], until) else _OPEN


class _Ahead:
    """The last pane of a stretch by the deadline of the one pending at its start, as if all its rows went to one window.

    ``upto, due, id``: a pane due at ``upto`` or before, later than the ``upto`` before, ends in the pane
    ``(due, id)``.  Chains of panes that meet are one.  Memory: the chains, at most the rows within
    a delay.
    """

    def __init__(self, limit: int, delay: int):
        self.limit, self.delay, self.closed = limit, delay, False
        self.upto = self.due = self.id = np.empty(0, np.int64)

    def feed(self, a: np.ndarray, seq: np.ndarray) -> None:
        if not self.closed:
            n = int(np.searchsorted(a, self.limit, "right")) + 1
            self.closed = n <= len(a)
            first = np.flatnonzero(np.diff(a[:n], prepend=self.upto[-1] if len(self.upto) else a[0] - 1))
            self.upto, self.due, self.id = (np.concatenate(x) for x in (
                (self.upto, a[first]), (self.due, a[first] + self.delay), (self.id, seq[first])))
        going = np.flatnonzero(self.due <= a[-1])
        while len(going):
            at = np.searchsorted(a, self.due[going])
            self.due[going], self.id[going] = a[at] + self.delay, seq[at]
            going = going[self.due[going] <= a[-1]]
        last = np.append(self.id[1:] != self.id[:-1], True)
        self.upto, self.due, self.id = self.upto[last], self.due[last], self.id[last]


_AHEAD = "struct<upto:array<bigint>,due:array<bigint>,id:array<bigint>,s:bigint,e:bigint,on:bigint>"
_FATES = ("key string, epoch long, stretch long, kind string, member long, fate int, due long, id long, on long, "
          f"used array<{_ENTRY}>, left array<{_ENTRY}>, ahead {_AHEAD}")
_FIELDS = ("s", "e", "on", "due", "id")


def _entries(given: list[dict]) -> list[list]:
    return [[x[c] for c in _FIELDS] for x in given]


def _run_stretches(ordered: DataFrame, delay: int, width: int) -> DataFrame:
    """Per stretch: its members' panes (``left`` null) and one row with the entries it was given (``used``) and leaves
    (``left``), and with what it would leave for others (``ahead``).

    ``ordered`` holds (key, epoch, stretch, a, seq, w, s, e, on, given) in order of arrival, a
    stretch's entries in a row of their own before its first, whose ``w`` is the next stretch of the epoch, if any.
    """
    entry = pa.list_(pa.struct([(n, pa.int64()) for n in _FIELDS]))
    ahead = pa.struct([(n, pa.list_(pa.int64())) for n in ("upto", "due", "id")] + [(n, pa.int64()) for n in ("s", "e", "on")])
    types = [pa.string(), pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), entry, entry, ahead]
    names = ["key", "epoch", "stretch", "kind", "member", "fate", "due", "id", "on", "used", "left", "ahead"]

    def members_of(fates: list[tuple]) -> pa.RecordBatch:
        """``fates``: (stretch, those of ``_Stretch``)."""
        sizes = [sum(map(len, f[2])) for f in fates]
        spread = pa.array(np.repeat(np.arange(len(fates)), sizes))
        heads = [[f[0][k] for f in fates] for k in range(3)] + [["row" if f[1] else "entry" for f in fates]]
        columns = [pa.array(c, t).take(spread) for c, t in zip(heads, types, strict=False)]
        columns.append(pa.array(np.concatenate([x for f in fates for x in f[2]])))
        columns += [pa.array([f[k] for f in fates], types[k + 2]).take(spread) for k in range(3, 7)]
        return pa.RecordBatch.from_arrays([*columns, *[pa.nulls(len(spread), t) for t in types[9:]]], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        stretch, head, used, last, fates, ends, n = None, None, [], None, [], [], 0

        def finish() -> None:
            left, (s, e, on), far = stretch.end(), last, stretch.ahead
            ends.append((*head, "left", None, None, None, None, None, *[[dict(zip(_FIELDS, x, strict=True)) for x in es] for es in (
                used, left)], None if far is None else {"upto": far.upto, "due": far.due, "id": far.id, "s": s, "e": e, "on": on}))

        def collect() -> None:
            nonlocal n
            fates.extend((head, *f) for f in stretch.fates)
            n += sum(len(x) for f in stretch.fates for x in f[1])
            stretch.fates = []

        for batch in batches:
            numbers = [batch.column(k).fill_null(0).to_numpy(zero_copy_only=False) for k in range(3, 9)]
            begins = np.flatnonzero(batch.column(9).is_valid().to_numpy(zero_copy_only=False)).tolist()
            for begin, end in zip([-1, *begins], [*begins, len(batch)], strict=True):
                if begin >= 0:
                    if stretch is not None:
                        finish()
                        collect()
                    key, epoch, at, _, _, then, *_, given = (c[0].as_py() for c in batch.slice(begin, 1).columns)
                    head, used = (key, epoch, at), _entries(given)
                    stretch = _Stretch(used, delay, at * width, (at + 1) * width, then is not None)
                if end > begin + 1:
                    stretch.feed(*[c[begin + 1:end] for c in numbers])
                    last = tuple(int(c[end - 1]) for c in numbers[3:])
                    collect()
                if n >= 8192:
                    yield members_of(fates)
                    fates, n = [], 0
        if stretch is not None:
            finish()
            collect()
        if fates:
            yield members_of(fates)
        for k in range(0, len(ends), 1024):
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*ends[k:k + 1024], strict=True), types, strict=True)], names)

    return ordered.mapInArrow(run, _FATES)


def _followed(state: DataFrame, width: int) -> DataFrame:
    """(_g, stretch, given, changed): the entries that each stretch should be given, from the first of its epoch on.

    ``state``: per stretch ``used, left, ahead``.  What a stretch left counts if it was given the right
    entries; else its ``ahead`` foretells it, and the next round shows whether that holds.
    """
    entry = pa.list_(pa.struct([(n, pa.int64()) for n in _FIELDS]))
    types = [pa.string(), pa.int64(), pa.int64(), entry, pa.bool_()]
    names = ["key", "epoch", "stretch", "given", "changed"]

    def foretold(given: list[list], ahead: dict, until: int) -> list[list]:
        due, pane = min((x[3], x[4]) for x in given) if given else (-NEVER, None)
        k = int(np.searchsorted(ahead["upto"], due))
        if k < len(ahead["upto"]):
            due, pane = ahead["due"][k], ahead["id"][k]
        left = [ahead["s"], ahead["e"], ahead["on"], due, pane]
        return [left] if _fate_at_end(left, until) == _OPEN else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        epoch, given = None, []
        for batch in batches:
            out = []
            for key, number, stretch, used, left, ahead in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                if (key, number) != epoch:
                    epoch, given = (key, number), []
                used = _entries(used)
                out.append((key, number, stretch, [dict(zip(_FIELDS, x, strict=True)) for x in given], given != used))
                if given == used:
                    given = _entries(left)
                elif ahead is not None:
                    given = foretold(given, ahead, (stretch + 1) * width)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), types, strict=True)], names)

    ordered = state.select("_g.key", "_g.epoch", "stretch", "used", "left", "ahead").repartition("key", "epoch").sortWithinPartitions(
        "key", "epoch", "stretch")
    return ordered.mapInArrow(run, f"key string, epoch long, stretch long, given array<{_ENTRY}>, changed boolean").select(
        F.struct("key", "epoch").alias("_g"), "stretch", "given", "changed")


#: Rounds at one width before stretches are made ``WIDER`` times as long.
ROUNDS, WIDER = 8, 16


def _settled(rows: DataFrame, delay: int, width: int) -> DataFrame:
    """Early rows (key, epoch, a, seq, w, s, e, on) with the pane they end in: ``fate``, ``due``, ``id``.

    Stretches of ``width`` microseconds are settled all at once.  A stretch begins with the
    entries that the one before leaves, at first none; those whose entries changed are settled
    again until nothing changes, which makes the result that of one pass in order.  Where rows
    are few, deadlines soon stop depending on how a stretch began; where they are many, there is
    mostly one window, and what stretches leave is foretold (``_followed``).  So a few rounds do;
    if not, stretches become longer, at last a whole epoch, which has no open start.
    """
    given, none = None, F.expr(f"CAST(array() AS array<{_ENTRY}>)")
    first, last = rows.agg(F.min("a"), F.max("a")).first()
    while True:
        parted = materialize(rows.withColumn("_g", F.struct("key", "epoch")).withColumn("stretch", F.floor(F.col("a") / width).cast("long")))
        seen = parted.select("_g", "stretch").distinct()
        follows = materialize(seen.withColumn("then", F.lead("stretch").over(Window.partitionBy("_g").orderBy("stretch"))))
        cells = ["_g", "stretch"]
        ask = follows.withColumn("given", none) if given is None else follows.join(given, cells, "left").select(
            *follows.columns, F.coalesce("given", none).alias("given"))
        done, state, rounds = [], None, 0
        while True:
            data = parted if not rounds else parted.join(ask.select(*cells), cells)
            data = data.select("_g.key", "_g.epoch", "stretch", "a", "seq", "w", "s", "e", "on", F.lit(None).cast(f"array<{_ENTRY}>").alias("given"))
            heads = ask.select("_g.key", "_g.epoch", "stretch", F.lit(-NEVER).cast("long").alias("a"), F.lit(None).cast("long").alias(
                "seq"), F.col("then").alias("w"), *[F.lit(None).cast("long").alias(c) for c in ("s", "e", "on")], "given")
            ordered = data.unionByName(heads).repartition("key", "epoch", "stretch").sortWithinPartitions(
                "key", "epoch", "stretch", "a", "seq")
            fresh = materialize(_run_stretches(ordered, delay, width).withColumn("_g", F.struct("key", "epoch")))
            ends = fresh.where("kind = 'left'").select(*cells, "used", "left", "ahead")
            state = materialize(ends if state is None else ends.unionByName(state.join(ask.select(*cells), cells, "left_anti")))
            done = [*[d.join(ask.select(*cells), cells, "left_anti") for d in done], fresh.where("kind <> 'left'").drop("used", "left", "ahead")]
            starts = materialize(_followed(state, width))
            ask = materialize(starts.where("changed").join(follows, cells).select(*cells, "then", "given"))
            rounds += 1
            if ask.isEmpty():
                return _panes_of(reduce(DataFrame.unionByName, done), follows)
            if rounds == ROUNDS and first // width != last // width:
                break
        # The entries at the starts of the longer stretches, as far as they are known.
        wider = F.floor(F.col("stretch") / WIDER).cast("long")
        given = materialize(starts.withColumn("_wide", wider).withColumn("_n", F.row_number().over(
            Window.partitionBy("_g", "_wide").orderBy("stretch"))).where("_n = 1").select("_g", F.col("_wide").alias("stretch"), "given"))
        width *= WIDER


def _panes_of(done: DataFrame, follows: DataFrame) -> DataFrame:
    """The rows' panes, those left open followed into the stretches after theirs."""
    links = done.join(follows, ["_g", "stretch"])
    final = F.when(F.col("fate") != _OPEN, F.col("fate")).when(F.col("then").isNull(), F.when(
        F.col("due") <= F.col("on"), _EARLY).otherwise(_ON_TIME))
    links = links.withColumn("fate", F.coalesce(final, F.lit(_OPEN)))
    rows = materialize(links.where("kind = 'row'").select("_g", F.col("member").alias("seq"), "fate", "due", "id", "then"))
    hops = materialize(links.where("kind = 'entry'").select("_g", F.col("stretch").alias("then"), F.col("member").alias("id"), F.struct(
        "fate", "due", "id", "then").alias("_next")))
    keys = ["_g", "then", "id"]

    def follow(df: DataFrame, name) -> DataFrame:
        moved = df.join(hops, keys, "left")
        go = (F.col("fate") == _OPEN) & F.col("_next").isNotNull()
        return moved.select(*name, *[F.when(go, F.col(f"_next.{c}")).otherwise(F.col(c)).alias(c) for c in ("fate", "due", "id", "then")])

    while not rows.where((F.col("fate") == _OPEN) & F.col("then").isNotNull()).isEmpty():
        rows = materialize(follow(rows, ["_g", "seq"]))
        flat = hops.select("_g", F.col("then").alias("_t"), F.col("id").alias("_i"), "_next.*")
        hops = materialize(follow(flat, ["_g", "_t", "_i"]).select("_g", F.col("_t").alias("then"), F.col("_i").alias("id"), F.struct(
            "fate", "due", F.col("id").alias("id"), F.col("then").alias("then")).alias("_next")))
    return rows.select("_g", "seq", "fate", "due", "id")


# ------------------------------------------------------------------ panes
def session_panes(log: DataFrame, gap: str, early_delay: str | None, lateness: str, watermark, mode: str = "accumulating",
                  bucket: str = "1 hour", with_dropped: bool = False):
    """Panes of merging session windows for an arrival log ``key, score, event_ts, arrival_ts, seq, wm_ts``.

    Output as of ``operators.panes.pane_ledger``: ``key, w_start, w_end, pane_index, on_time_index,
    timing, is_first, is_last, value, fire_ts``; with ``with_dropped`` also the rows that came too
    late.  ``seq`` orders rows of equal arrival time within a key.
    """
    g, late, b = dur_us(gap), dur_us(lateness), dur_us(bucket)
    watermark = watermark.resolve(log)
    all_rows = log.select("key", F.col("score").cast("bigint").alias("score"), to_us("event_ts").alias("t"), to_us(
        "arrival_ts").alias("a"), F.col("seq").cast("long").alias("seq"), to_us("wm_ts").alias("w"))
    too_late = F.col("w") >= F.col("t") + g + late
    rows = materialize(all_rows.where(~too_late))
    positions = _positions(rows, g, late, b)
    rows = _with_bounds(rows, positions, g).withColumn("early", F.col("w") < F.col("e"))
    rows = running_sums(rows.withColumn("_b", F.floor(F.col("a") / b)), _WINDOW, ["a", "seq"], "_b", {"so_far": F.col("score")})
    rows = materialize(rows.drop("_b"))
    windows = _windows(rows, b)
    ends = watermark.attach(windows, {"on": F.col("e"), "gc": F.col("e") + F.lit(late)}, log)
    windows = materialize(ends.withColumn("fires", F.col("own_early").isNotNull() & (F.col("dies.w") >= F.col("e"))))
    of_window = windows.select(F.struct(*_WINDOW).alias("_w"), F.col("inside").alias("before"), to_us("on_ts").alias("on"), "on_ts", "on_seq", "gc_ts", "gc_seq")
    rows = materialize(rows.withColumn("_w", F.struct(*_WINDOW)).join(of_window.select("_w", "before", "on"), "_w").withColumn(
        "total", F.col("before") + F.col("so_far")).drop("_w", "before", "so_far"))

    # Without an early delay the deadlines only tell what an on-time pane adds; nothing is due before it.
    d = dur_us(early_delay) if early_delay is not None else 2**61
    width = max(16 * d, dur_us("4 hours")) if early_delay is not None else dur_us("4 hours")
    early_rows = rows.where("early")
    settled = _settled(early_rows.select("key", "epoch", "a", "seq", "w", "s", "e", "on"), d, width)
    last = F.max(F.struct("a", "seq", "s", "e", "total")).alias("m")
    phase = F.when(F.col("fate") == _EARLY, F.lit(0)).otherwise(F.lit(1))
    by_pane = materialize(early_rows.withColumn("_g", F.struct("key", "epoch")).join(settled, ["_g", "seq"]).groupBy("_g", "id").agg(
        F.min("fate").alias("fate"), F.min("due").alias("due"), F.sum("score").alias("delta"), last).select(
            "_g.key", "_g.epoch", "m.s", "m.e", phase.alias("phase"), "due", F.col("id").alias("sub"), "delta", F.col("m.total").alias("acc")))
    waiting = by_pane.where("phase = 1").groupBy(F.struct(*_WINDOW).alias("_w")).agg(F.sum("delta").alias("delta"))
    fired = windows.where("fires").withColumn("_w", F.struct(*_WINDOW)).join(waiting, "_w", "left").select(
        *_WINDOW, F.lit(1).alias("phase"), F.col("on_ts").alias("fire_ts"), F.lit(0).cast("long").alias("sub"), F.coalesce(
            "delta", F.lit(0).cast("bigint")).alias("delta"), (F.col("inside") + F.col("own_early")).alias("acc"))
    early_panes = by_pane.where("phase = 0").select(*_WINDOW, "phase", from_us(F.col("due")).alias("fire_ts"), "sub", "delta", "acc")
    late_panes = rows.where("NOT early").select(
        *_WINDOW, F.lit(2).alias("phase"), from_us(F.col("a")).alias("fire_ts"), F.col("seq").alias("sub"), F.col("score").alias("delta"),
        F.col("total").alias("acc"))
    panes = early_panes.unionByName(fired).unionByName(late_panes).withColumn("_w", F.struct(*_WINDOW)).join(
        of_window.select("_w", "on_ts", "on_seq", "gc_ts", "gc_seq"), "_w").drop("_w")
    panes = materialize(panes.select("key", "epoch", from_us(F.col("s")).alias("w_start"), from_us(F.col("e")).alias("w_end"), "phase",
                                     "fire_ts", "sub", "delta", "acc", F.lit(False).alias("closing"),
                                     "on_ts", "on_seq", "gc_ts", "gc_seq"))
    result = number_panes(panes, PaneSpec(mode=mode, bucket=bucket), ["key", "epoch", "w_start", "w_end"], "acc")
    if not with_dropped:
        return result
    return result, all_rows.where(too_late).select("key", "score", from_us(F.col("t")).alias("event_ts"), from_us(
        F.col("a")).alias("arrival_ts"), "seq", from_us(F.col("w")).alias("wm_ts"))
