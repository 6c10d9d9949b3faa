"""Sequence detection over streams with keyed state and event-time timers.

Rows of a key wait until the watermark has passed them and are then replayed in (event time, sequence) order, so results
do not depend on how the stream is cut into batches. What happens on a row or at a deadline is described by a small rule.

State. Keys are dealt to BUCKETS groups by a hash, and the state of a group is that of all its keys: a batch calls each group
once, however many keys it has, since most of the time of a call with few rows goes into asking for state and timers. One
value per group holds a short text: the timer, few waiting rows, and what the rule knows of few keys. More keys lie in blocks
of a map, of which a firing reads those with a key that has rows or a deadline. More waiting rows lie in another map, in
sorted pieces of bounded length, and a firing reads and rewrites only pieces that the watermark has reached. Rules that keep
rows of their own (partial matches, unmatched rows) use first-in-first-out queues whose full chunks lie in a third map, so a
key with a million waiting rows costs a firing no more than one with a few.

Hot keys. Where a rule looks only a bounded time ahead (patterns) or starts anew at fixed times (daily caps), the state is
that of a (key, time slice): rows are copied into the earlier slices that may still wait for them, each slice answers for
its own rows, and a key's slices lie in different groups and state partitions.
"""

from __future__ import annotations

import json
import zlib
from collections.abc import Iterator, Sequence
from heapq import heapify, heappop, heappush
from itertools import islice
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.functions.clock import DAY_US, Span, floor_div, micros, span_us
from tidemark.operators.capping import DROP, PASS, WARN
from tidemark.operators.pairing import LEFT_ONLY, PAIRED, RIGHT_ONLY
from tidemark.operators.sequences import MATCHED, TIMEOUT, Pattern
from tidemark.streaming.windows import event_time

Output = tuple
_OUTPUT = "outcome STRING, a_us BIGINT, a_seq BIGINT, b_us BIGINT, b_seq BIGINT, n BIGINT, at_us BIGINT"
_PATHS = "outcome STRING, us ARRAY<BIGINT>, seq ARRAY<BIGINT>, at_us BIGINT"
#: Groups that keys are dealt to. A stream's checkpoint holds for the number it was begun with.
BUCKETS = 512
#: A group's waiting rows, and its keys with state, up to these numbers lie in its value.
FEW_ROWS = 128
FEW_KEYS = 256
#: Blocks of a group that has more keys with state.
KEY_BLOCKS = 64
#: Results handed on in one text.
PACKED_ROWS = 1000
#: Rows of one sorted piece, and of a chunk of a queue.
PIECE_ROWS = 2048
CHUNK_ROWS = 64
#: Neighbouring numbers of one bitmap of a set.
BLOCK_BITS = 4096
#: Stands for a missing visitor.
NOBODY = -(1 << 63)
#: Arriving rows of a group are sorted and stored in portions of this many.
ARRIVING_ROWS = 4 * PIECE_ROWS


class Queue:
    """Items first in first out. ``place`` is [first chunk, items taken from it, next chunk, items behind the last chunk]."""

    def __init__(self, chunks: Any, owner: int, number: int, place: list):
        self.chunks, self.owner, self.number, self.place = chunks, owner, number, place
        self.front: list | None = None

    def _front(self) -> list | None:
        if self.place[0] < self.place[2] and self.front is None:
            self.front = json.loads(self.chunks.getValue((self.owner, self.number, self.place[0]))[0])
        return self.front

    def __bool__(self) -> bool:
        return self.place[0] < self.place[2] or bool(self.place[3])

    def first(self) -> list:
        front = self._front()
        return front[self.place[1]] if front is not None else self.place[3][0]

    def append(self, item: list) -> None:
        self.place[3].append(item)
        if len(self.place[3]) == CHUNK_ROWS:
            self.chunks.updateValue((self.owner, self.number, self.place[2]), (json.dumps(self.place[3]),))
            self.place[2] += 1
            self.place[3] = []

    def popleft(self) -> list:
        front = self._front()
        if front is None:
            return self.place[3].pop(0)
        item = front[self.place[1]]
        self.place[1] += 1
        if self.place[1] == len(front):
            self.chunks.removeKey((self.owner, self.number, self.place[0]))
            self.place[0], self.place[1], self.front = self.place[0] + 1, 0, None
        return item

    def take(self, holds: Any) -> Iterator[list]:
        """All items but the leading ones that ``holds`` keeps back."""
        held = []
        while self and holds(self.first()):
            held.append(self.popleft())
        while self:
            yield self.popleft()
        for item in held:
            self.append(item)


class Members:
    """A set of whole numbers as bitmaps of BLOCK_BITS neighbours; a firing reads and writes the blocks it touches once.

    Only for rules whose keys are ``alone``: ``clear`` takes all chunks of the group.
    """

    def __init__(self, chunks: Any):
        self.chunks = chunks
        self.read: dict[int, bytearray] = {}
        self.changed: set[int] = set()

    def add(self, value: int) -> bool:
        """Whether ``value`` is new."""
        number, at = divmod(value, BLOCK_BITS)
        if number not in self.read:
            held = self.chunks.getValue((-1, -1, number))
            self.read[number] = bytearray.fromhex(held[0]) if held is not None else bytearray(BLOCK_BITS // 8)
        block, mask = self.read[number], 1 << (at & 7)
        if block[at >> 3] & mask:
            return False
        block[at >> 3] |= mask
        self.changed.add(number)
        return True

    def save(self) -> None:
        for number in self.changed:
            self.chunks.updateValue((-1, -1, number), (self.read[number].hex(),))
        self.changed.clear()

    def clear(self) -> None:
        self.chunks.clear()
        self.read, self.changed = {}, set()


class Crowd:
    """What is known of the keys of a group: by name, a list that begins with the time it is due at, or None.

    Up to FEW_KEYS go with the group's value; more lie in KEY_BLOCKS blocks of a map by a hash of the name. ``listed`` are
    the blocks not read, each with the earliest time in it.
    """

    def __init__(self, blocks: Any, items: dict[str, list], listed: list):
        self.blocks, self.items, self.listed = blocks, items, dict(listed)
        self.read: set[int] = set()

    @staticmethod
    def _block(name: str) -> int:
        return zlib.crc32(name.encode()) % KEY_BLOCKS

    def _read(self, number: int) -> None:
        del self.listed[number]
        self.items.update(json.loads(self.blocks.getValue((number,))[0]))
        self.read.add(number)

    def get(self, name: str) -> list | None:
        if self.listed and name not in self.items and (number := self._block(name)) in self.listed:
            self._read(number)
        return self.items.get(name)

    def due(self, until: int) -> list[str]:
        for number in [number for number, due in self.listed.items() if due is not None and due <= until]:
            self._read(number)
        return [name for name, item in self.items.items() if item[0] is not None and item[0] <= until]

    def earliest(self) -> int | None:
        times = [item[0] for item in self.items.values()] + list(self.listed.values())
        return min((time for time in times if time is not None), default=None)

    def take(self) -> Iterator[tuple[str, list]]:
        """All keys, block by block; none is left."""
        while True:
            yield from self.items.items()
            self.items = {}
            if not self.listed:
                return
            self._read(next(iter(self.listed)))

    def save(self) -> list:
        """What goes with the group's value: few keys, and the blocks."""
        written: dict[int, dict] = {}
        if len(self.items) > FEW_KEYS:
            for number in {self._block(name) for name in self.items} & self.listed.keys():
                self._read(number)
            for name, item in self.items.items():
                written.setdefault(self._block(name), {})[name] = item
            self.items = {}
        for number, items in written.items():
            self.blocks.updateValue((number,), (json.dumps(items),))
            self.listed[number] = min((item[0] for item in items.values() if item[0] is not None), default=None)
        for number in self.read - written.keys():
            self.blocks.removeKey((number,))
        return [self.items, list(self.listed.items())]


class State:
    """What a rule knows of a key: a short list of numbers, its queues and a set of members."""

    def __init__(self, owner: int, numbers: list, queues: list[Queue], members: Members):
        self.owner, self.numbers, self.queues, self.members = owner, numbers, queues, members

    def __bool__(self) -> bool:
        return bool(self.numbers) or any(self.queues)


class Rule:
    """Reacts to one key's events in order; its state is empty when nothing is pending."""

    queues = 0
    output = _OUTPUT
    #: Whether each key is a group of its own, because its state is large.
    alone = False

    @staticmethod
    def pack(us: int, name: str, kind: int, seq: int) -> list:
        """A waiting row, so that rows sort as they are replayed. A row that closes and opens comes twice and closes first."""
        return [us, name, seq, -kind]

    @staticmethod
    def unpack(row: list) -> tuple[int, str, int, int]:
        """Time, name, kind and sequence number."""
        return row[0], row[1], -row[3], row[2]

    def on_row(self, state: State, us: int, seq: int, kind: int) -> Iterator[Output]:
        raise NotImplementedError

    def on_untimed(self, state: State, seq: int) -> Iterator[Output]:
        """A row without a time, as it arrives."""
        return iter(())

    def deadline(self, state: State) -> int | None:
        """Time after which ``on_deadline`` is due; rows at that very time come first."""
        return None

    def on_deadline(self, state: State) -> Iterator[Output]:
        return iter(())


class Chain(Rule):
    """A pattern as an automaton. A row's kind holds one bit for each stage it meets.

    Queue ``i`` holds the partial matches whose next stage is ``i + 1``, oldest first; all of them take the same row, so a
    row that meets no awaited stage touches none, and each partial match moves once for each stage.
    """

    output = _PATHS

    def __init__(self, strict: list[bool], span: int):
        self.strict, self.span = strict, span
        self.queues = len(strict) - 1

    def on_row(self, state, us, seq, kind):
        for stage in range(self.queues, 0, -1):
            met = kind >> stage & 1
            if not met and not self.strict[stage] or not state.queues[stage - 1]:
                continue
            # One begun a whole span ago has timed out; one whose very next row is another is broken.
            for path in state.queues[stage - 1].take(lambda path: us - path[0] >= self.span):
                if met:
                    yield from self._reached(state, stage, [*path, us, seq], us)
        if kind & 1:
            yield from self._reached(state, 0, [us, seq], us)

    def _reached(self, state, stage, path, us):
        if stage == self.queues:
            yield MATCHED, path[::2], path[1::2], us
        else:
            state.queues[stage].append(path)

    def _oldest(self, state):
        waiting = [queue for queue in state.queues if queue]
        return min(waiting, key=lambda queue: queue.first()[0]) if waiting else None

    def deadline(self, state):
        oldest = self._oldest(state)
        return oldest.first()[0] + self.span if oldest is not None else None

    def on_deadline(self, state):
        path = self._oldest(state).popleft()
        yield TIMEOUT, path[::2], path[1::2], path[0] + self.span


class OpenClose(Rule):
    """kind 0 opens, kind 1 closes; only the latest open row counts, and only for ``patience``."""

    @staticmethod
    def pack(us, name, kind, seq):
        """Rows of equal time by kind first."""
        return [us, name, kind, seq]

    unpack = staticmethod(tuple)

    def __init__(self, span: int, patience: int):
        self.span, self.patience = span, patience

    def on_row(self, state, us, seq, kind):
        if kind == 0:
            yield from self.on_deadline(state)
            state.numbers = [us, seq]
        elif state.numbers:
            opened, opened_seq = state.numbers
            state.numbers = []
            yield "paid" if us - opened < self.span else "paid_late", opened, opened_seq, us, seq, None, us
        else:
            yield "orphan_pay", None, None, us, seq, None, us

    def deadline(self, state):
        return state.numbers[0] + self.patience if state.numbers else None

    def on_deadline(self, state):
        if state.numbers:
            us, seq = state.numbers
            state.numbers = []
            yield TIMEOUT, us, seq, None, None, None, us + self.span


class Burst(Rule):
    """kind 0 is a failure, kind 1 a success. Numbers: first time and number, last time, count."""

    def __init__(self, span: int, least: int):
        self.span, self.least = span, least

    def on_row(self, state, us, seq, kind):
        if kind == 1:
            state.numbers = []
        elif state.numbers:
            state.numbers[2:] = us, state.numbers[3] + 1
        else:
            state.numbers = [us, seq, us, 1]
        return iter(())

    def deadline(self, state):
        return state.numbers[0] + self.span if state.numbers else None

    def on_deadline(self, state):
        first, seq, last, n = state.numbers
        state.numbers = []
        if n >= self.least:
            yield "burst", first, seq, last, None, n, first + self.span


class DailyCap(Rule):
    """Numbers: local day number and how many rows it had. Rows without a time are a day of their own."""

    def __init__(self, cap: int, offset: int):
        self.cap, self.offset = cap, offset

    def on_row(self, state, us, seq, kind):
        day = None if us is None else (us + self.offset) // DAY_US
        state.numbers = [day, state.numbers[1] + 1 if state.numbers and state.numbers[0] == day else 1]
        rank = state.numbers[1]
        yield PASS if rank <= self.cap else WARN if rank == self.cap + 1 else DROP, us, seq, None, None, rank, us

    def on_untimed(self, state, seq):
        return self.on_row(state, None, seq, 0)

    def deadline(self, state):
        return (state.numbers[0] + 1) * DAY_US - self.offset if state.numbers and state.numbers[0] is not None else None

    def on_deadline(self, state):
        state.numbers = []
        return iter(())


class Reconcile(Rule):
    """kind 0 is left, kind 1 right. The queue holds waiting rows of whichever side waits, oldest first."""

    queues = 1

    @staticmethod
    def pack(us, name, kind, seq):
        """Rows of equal time by kind first."""
        return [us, name, kind, seq]

    unpack = staticmethod(tuple)

    def __init__(self, left_wait: int, right_wait: int):
        self.waits = (left_wait, right_wait)

    def on_row(self, state, us, seq, kind):
        (waiting,) = state.queues
        if waiting and waiting.first()[0] != kind:
            _, other_us, other_seq = waiting.popleft()
            a, b = ((us, seq), (other_us, other_seq)) if kind == 0 else ((other_us, other_seq), (us, seq))
            yield PAIRED, *a, *b, None, us
        else:
            waiting.append([kind, us, seq])

    def deadline(self, state):
        (waiting,) = state.queues
        return waiting.first()[1] + self.waits[waiting.first()[0]] if waiting else None

    def on_deadline(self, state):
        side, us, seq = state.queues[0].popleft()
        at = us + self.waits[side]
        if side == 0:
            yield LEFT_ONLY, us, seq, None, None, None, at
        else:
            yield RIGHT_ONLY, None, None, us, seq, None, at


class RunningDistinct(Rule):
    """A row's kind is its visitor. Numbers: visitors so far and the end of the window, after which all is forgotten."""

    output = "us BIGINT, seq BIGINT, visitor BIGINT, n BIGINT"
    alone = True

    def __init__(self, size: int):
        self.size = size

    def on_row(self, state, us, seq, kind):
        if not state.numbers:
            state.numbers = [0, (us // self.size + 1) * self.size]
        if state.members.add(kind):
            state.numbers[0] += 1
            yield us, seq, kind, state.numbers[0]

    def deadline(self, state):
        # The last row of a window is before its end.
        return state.numbers[1] if state.numbers else None

    def on_deadline(self, state):
        state.numbers = []
        state.members.clear()
        return iter(())


class OrderedReplay(StatefulProcessor):
    """Keeps a group's rows until the watermark passes them and replays them through a rule, which sees one key at a time.

    A row's last column is a text of its time, sequence number, kind and the name of its key, as each further column costs as
    much again; results go out as JSON texts of many, with the name as ``_name``.
    """

    def __init__(self, rule: Rule, columns: list[str]):
        self.rule, self.columns = rule, columns

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.value = handle.getValueState("value", "json STRING")
        self.pieces = handle.getMapState("pieces", "number BIGINT", "json STRING")
        self.blocks = handle.getMapState("blocks", "number BIGINT", "json STRING")
        self.chunks = handle.getMapState("chunks", "owner BIGINT, queue INT, number BIGINT", "json STRING")

    def _load(self) -> None:
        """``timer``, few waiting rows, stored pieces as (first time, number), the next number, and the keys with state."""
        held = self.value.get()
        self.timer, self.few, self.stored, self.next, crowd = json.loads(held[0]) if held is not None else (None, [], [], 0, ({}, []))
        self.crowd = Crowd(self.blocks, *crowd)
        self.states: dict[str, State] = {}

    def _state(self, name: str) -> State:
        state = self.states.get(name)
        if state is None:
            held = self.crowd.get(name)
            if held is None:
                owner, numbers, places = self.next, [], [[0, 0, 0, []] for _ in range(self.rule.queues)]
                self.next += 1
            else:
                _, owner, numbers, places = held
            queues = [Queue(self.chunks, owner, i, place) for i, place in enumerate(places)]
            state = self.states[name] = State(owner, numbers, queues, Members(self.chunks))
        return state

    def _keep_states(self) -> None:
        for name, state in self.states.items():
            state.members.save()
            if state:
                self.crowd.items[name] = [self.rule.deadline(state), state.owner, state.numbers, [queue.place for queue in state.queues]]
            else:
                self.crowd.items.pop(name, None)
        self.states = {}

    def _save(self) -> None:
        few_keys, listed = self.crowd.save()
        if self.timer is None and not self.few and not self.stored and not few_keys and not listed:
            self.value.clear()
            return
        self.value.update((json.dumps([self.timer, self.few, self.stored, self.next, [few_keys, listed]]),))

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues: Any) -> Iterator[Row]:
        self._load()
        arrived, untimed, first = [], [], None
        pack = self.rule.pack
        for *_, text in rows:
            us, seq, kind, name = text.split(" ", 3)
            seq = int(seq) if seq else None
            if not us:
                untimed.append((name, seq))
                continue
            arrived.append(pack(int(us), name, int(kind), seq))
            if len(arrived) == ARRIVING_ROWS:
                first = self._store(arrived, first)
                arrived = []
        if arrived:
            if len(self.few) + len(arrived) <= FEW_ROWS:
                self.few += arrived
                earliest = min(row[0] for row in arrived)
                first = earliest if first is None else min(first, earliest)
            else:
                first = self._store(arrived, first)
        yield from self._packed(self._untimed(untimed))
        if first is not None:
            self._wake_at(first)
        self._save()

    def _untimed(self, rows: list[tuple]) -> Iterator[tuple]:
        for name, seq in sorted(rows, key=lambda row: (row[0], row[1] is not None, row[1])):
            for output in self.rule.on_untimed(self._state(name), seq):
                yield name, *output
        self._keep_states()

    def _store(self, rows: list[list], first: int | None) -> int:
        """Put rows away in sorted pieces; the earliest time so far."""
        rows.sort()
        for low in range(0, len(rows), PIECE_ROWS):
            self._put(rows[low : low + PIECE_ROWS])
        return rows[0][0] if first is None else min(first, rows[0][0])

    def _put(self, rows: list) -> None:
        self.pieces.updateValue((self.next,), (json.dumps(rows),))
        self.stored.append([rows[0][0], self.next])
        self.next += 1

    def _ready(self, now: int) -> Iterator[list]:
        """Waiting rows up to ``now`` in order; a piece is read when the first of its rows is due."""
        waiting = [row for row in self.few if row[0] <= now]
        self.few = [row for row in self.few if row[0] > now]
        heapify(waiting)
        self.stored.sort(reverse=True)
        while waiting or self.stored and self.stored[-1][0] <= now:
            while self.stored and self.stored[-1][0] <= (waiting[0][0] if waiting else now):
                _, number = self.stored.pop()
                rows = json.loads(self.pieces.getValue((number,))[0])
                self.pieces.removeKey((number,))
                due = sum(1 for row in rows if row[0] <= now)
                for row in rows[:due]:
                    heappush(waiting, row)
                if due < len(rows):
                    self._put(rows[due:])
                    self.stored.sort(reverse=True)
            yield heappop(waiting)

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[Row]:
        now = timerValues.getCurrentWatermarkInMs() * 1000
        self._load()
        self.timer = None
        yield from self._packed(self._replay(now))
        due = [row[0] for row in self.few] + [first for first, _ in self.stored]
        if (deadline := self.crowd.earliest()) is not None:
            due.append(deadline)
        if due:
            self._wake_at(min(due))
        self._save()

    def _replay(self, now: int) -> Iterator[tuple]:
        unpack, on_row = self.rule.unpack, self.rule.on_row
        for row in self._ready(now):
            us, name, kind, seq = unpack(row)
            state = self._state(name)
            for output in self._settled(state, us - 1):
                yield name, *output
            for output in on_row(state, us, seq, kind):
                yield name, *output
        for name in [*self.states, *(name for name in self.crowd.due(now) if name not in self.states)]:
            for output in self._settled(self._state(name), now):
                yield name, *output
        self._keep_states()

    def _packed(self, outputs: Iterator[tuple]) -> Iterator[Row]:
        while rows := list(islice(outputs, PACKED_ROWS)):
            yield Row(out=json.dumps([dict(zip(self.columns, row)) for row in rows]))

    def _settled(self, state: State, until: int) -> Iterator[Output]:
        while (due := self.rule.deadline(state)) is not None and due <= until:
            yield from self.rule.on_deadline(state)

    def _wake_at(self, us: int) -> None:
        """Keep one timer per group, at the earliest time anything is due."""
        ms = -(-us // 1000)
        if self.timer is not None:
            if self.timer <= ms:
                return
            self.handle.deleteTimer(self.timer)
        self.handle.registerTimer(ms)
        self.timer = ms

    def close(self) -> None:
        pass


_EXACT = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXXXX", "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"}


def key_name(rows: DataFrame, keys: Sequence[str]) -> Column:
    """The keys of a row as one text, equal for equal keys; nulls are equal."""
    fields = []
    for i, k in enumerate(keys):
        # Of the two zeros, which are one key, the text would make two.
        zero = isinstance(rows.schema[k].dataType, (T.FloatType, T.DoubleType))
        fields.append((F.when(F.col(k) != 0, F.col(k)).when(F.col(k) == 0, 0.0).cast(rows.schema[k].dataType) if zero else F.col(k)).alias(f"k{i}"))
    return F.to_json(F.struct(*fields), _EXACT) if fields else F.lit("{}")


def named_keys(out: DataFrame, name: Column, rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``out`` with the columns ``keys`` of ``rows`` read back from ``key_name``."""
    if not keys:
        return out
    schema = T.StructType([T.StructField(f"k{i}", rows.schema[k].dataType) for i, k in enumerate(keys)])
    read = out.withColumn("_keys", F.from_json(name, schema, _EXACT))
    return read.select(*[F.col(f"_keys.k{i}").alias(k) for i, k in enumerate(keys)], *out.columns)


def bucket_of(name: Column | str) -> Column:
    return F.pmod(F.xxhash64(name), F.lit(BUCKETS))


def unpacked(packed: DataFrame, output: str) -> DataFrame:
    """Rows from texts of many, with ``_name``."""
    schema = T.StructType([T.StructField("_name", T.StringType()), *T.StructType.fromDDL(output).fields])
    return packed.select(F.inline(F.from_json("out", T.ArrayType(schema))))


def _replayed(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    kind: Column,
    rule: Rule,
    delay: Span,
    slices: Column | None = None,
    untimed: bool = False,
    kinds: str = "int",
) -> DataFrame:
    """Rows with a non-null ``kind`` replayed through ``rule``; one output row per result.

    ``slices``, an array of (slice, kind) from ``_us`` and ``_kind``, says in which time slices of its key a row counts,
    and as what. Rows without a time are left out unless ``untimed``.
    """
    keys = list(keys)
    timed = event_time(stream, ts, delay)
    events = timed.select(
        ts, micros(timed, ts).alias("_us"), F.col(seq).cast("bigint").alias("_seq"), kind.alias("_kind"),
        key_name(timed, keys).alias("_name"),
    )
    events = events.withColumn("_kind", F.col("_kind").cast(kinds))
    if not untimed:
        # Rows without a kind still move the watermark: a condition on the event time stays above it.
        events = events.where(F.when(F.col("_kind").isNotNull(), F.col("_us")).isNotNull())
    slice = F.lit("")
    if slices is not None:
        events = events.withColumn("_at", F.explode(slices)).withColumn("_kind", F.col("_at.kind").cast(kinds))
        slice = F.coalesce(F.col("_at.slice").cast("string"), F.lit("none"))
    name = F.concat_ws(" ", slice, "_name")
    group = name if rule.alone else bucket_of(name)
    text = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("_us", "_seq", "_kind")]
    events = events.select(group.alias("_group"), ts, F.concat_ws(" ", *text, name).alias("_row"))
    columns = ["_name", *T.StructType.fromDDL(rule.output).names]
    packed = events.groupBy("_group").transformWithState(OrderedReplay(rule, columns), "out STRING", "Append", "EventTime")
    out = unpacked(packed, rule.output)
    return named_keys(out, F.expr("substring(_name, locate(' ', _name) + 1)"), timed, keys).drop("_name")


def _time(us: str | Column) -> Column:
    return F.timestamp_micros(us)


def _two_kinds(first: Column, second: Column) -> Column:
    return F.when(first, 0).when(second, 1)


def stream_match(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    pattern: Pattern,
    delay: Span = "1 millisecond",
    slice: Span | None = None,
) -> DataFrame:
    """``match`` of any ``Pattern`` over a stream, timeouts included.

    State is that of a (key, time slice); a row is also seen by the earlier slices in which a match that it may continue can
    have begun. ``slice`` is their width, 16 times the pattern's time if not given: narrower slices spread a hot key
    further and copy more rows.
    """
    if pattern.span is None:
        raise ValueError("close the pattern with within(...)")
    stages = pattern.steps()
    span = span_us(pattern.span)
    width = span_us(slice) if slice is not None else 16 * span
    met = F.lit(0)
    for number, stage in enumerate(stages):
        met = met + F.when(F.coalesce(stage.condition, F.lit(False)), 1 << number).otherwise(0)
    strict = any(stage.strict for stage in stages)
    kind = met if strict else F.when(met > 0, met)
    own = floor_div(F.col("_us"), width)
    # A row begins matches in its own slice only, and continues those begun less than a span ago.
    continued = F.col("_kind").bitwiseAND(-2)
    halo = F.transform(
        F.sequence(floor_div(F.col("_us") - (span - 1), width), own),
        lambda at: F.struct(at.alias("slice"), F.when(at == own, F.col("_kind")).otherwise(continued).alias("kind")),
    )
    slices = halo if strict else F.filter(halo, lambda at: at["kind"] > 0)
    rule = Chain([stage.strict for stage in stages], span)
    out = _replayed(stream, keys, ts, seq, kind, rule, delay, slices)
    columns = []
    for number, stage in enumerate(stages):
        columns += [_time(F.get("us", F.lit(number))).alias(f"{stage.name}_ts"), F.get("seq", F.lit(number)).alias(f"{stage.name}_seq")]
    return out.select(*keys, *columns, "outcome", _time("at_us").alias("at"))


def stream_followed_by(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    opens: Column,
    closes: Column,
    within: Span,
    delay: Span = "1 millisecond",
    slice: Span | None = None,
) -> DataFrame:
    """``stream_match`` of "opens followed by closes within"."""
    pattern = Pattern.begin("open", opens).followed_by("close", closes).within(within)
    return stream_match(stream, keys, ts, seq, pattern, delay, slice)


def stream_open_close_outcomes(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    opens: Column,
    closes: Column,
    within: Span,
    patience: Span,
    delay: Span = "1 millisecond",
) -> DataFrame:
    """``open_close_outcomes`` over a stream.

    A late closing is recognised for ``patience`` after the opening; then the
    opening is reported as a timeout and forgotten.
    """
    rule = OpenClose(span_us(within), span_us(patience))
    out = _replayed(stream, keys, ts, seq, _two_kinds(opens, closes), rule, delay)
    return out.select(
        *keys, "outcome", _time("a_us").alias("open_ts"), F.col("a_seq").alias("open_seq"),
        _time("b_us").alias("close_ts"), F.col("b_seq").alias("close_seq"), _time("at_us").alias("at"),
    )


def stream_failure_bursts(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    failed: Column,
    within: Span,
    min_failures: int,
    delay: Span = "1 millisecond",
) -> DataFrame:
    """``failure_bursts`` over a stream; an alarm is raised when its deadline has passed."""
    kind = F.when(F.coalesce(failed, F.lit(False)), 0).otherwise(1)
    out = _replayed(stream, keys, ts, seq, kind, Burst(span_us(within), min_failures), delay)
    return out.select(
        *keys, _time("a_us").alias("first_ts"), F.col("a_seq").alias("first_seq"), _time("b_us").alias("last_ts"),
        F.col("n").alias("n_fails"),
    )


def stream_cap_outcomes(
    stream: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    cap: int,
    utc_offset: Span = "8 hours",
    delay: Span = "1 millisecond",
    days: int = 16,
) -> DataFrame:
    """``cap_outcomes`` over a stream: each event's rank of the day and whether it passes.

    State is that of a (key, stretch of ``days`` local days); one day spreads a hot key furthest. Rows without a time rank on
    a day of their own as they arrive, and are answered at once.
    """
    offset = span_us(utc_offset)
    slices = F.array(F.struct(floor_div(F.col("_us") + offset, days * DAY_US).alias("slice"), F.lit(0).alias("kind")))
    out = _replayed(stream, keys, ts, seq, F.lit(0), DailyCap(cap, offset), delay, slices, untimed=True)
    return out.select(
        *keys, _time("a_us").alias(ts), F.col("a_seq").alias(seq), F.col("n").alias("day_rank"), "outcome"
    )


def stream_reconcile(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    ts: str,
    seq: str,
    left_waits: Span,
    right_waits: Span,
    delay: Span = "1 millisecond",
) -> DataFrame:
    """``reconcile`` of two streams with equal column names, as one keyed stream of both.

    Rows without a key or a time meet nobody: they pass the state by and are single at once.
    """
    sides = left.select(*keys, ts, seq, F.lit(0).alias("_side")).unionByName(
        right.select(*keys, ts, seq, F.lit(1).alias("_side"))
    )
    whole = F.col(ts).isNotNull()
    for key in keys:
        whole = whole & F.col(key).isNotNull()
    rule = Reconcile(span_us(left_waits), span_us(right_waits))
    out = _replayed(sides.where(whole), keys, ts, seq, F.col("_side"), rule, delay)
    met = out.select(
        *keys, "outcome", _time("a_us").alias("pay_ts"), F.col("a_seq").alias("pay_seq"),
        _time("b_us").alias("receipt_ts"), F.col("b_seq").alias("receipt_seq"),
    )
    lone = sides.where(~whole)
    time, number, is_left = _time(micros(lone, ts)), F.col(seq).cast("bigint"), F.col("_side") == 0
    return met.unionByName(lone.select(
        *keys, F.when(is_left, LEFT_ONLY).otherwise(RIGHT_ONLY).alias("outcome"),
        F.when(is_left, time).alias("pay_ts"), F.when(is_left, number).alias("pay_seq"),
        F.when(~is_left, time).alias("receipt_ts"), F.when(~is_left, number).alias("receipt_seq"),
    ))


def stream_running_visitors(
    stream: DataFrame, ts: str, seq: str, size: Span, user: str, delay: Span = "1 millisecond", keys: Sequence[str] = ()
) -> DataFrame:
    """``running_visitors`` over a stream: a row for each user's first event in a window, with the distinct count so far.

    Rows come out as the watermark passes them, not at the window's end. Users are whole numbers; a window's users are kept
    as bitmaps in blocks until it ends. Rows without a user are one user (the least 64-bit number is taken for it too); rows
    without a time are left out. Each window, and each value of ``keys`` in it, is one state.
    """
    size_us = span_us(size)
    slices = F.array(F.struct(floor_div(F.col("_us"), size_us).alias("slice"), F.col("_kind").alias("kind")))
    visitor = F.coalesce(F.col(user).cast("bigint"), F.lit(NOBODY))
    out = _replayed(stream, keys, ts, seq, visitor, RunningDistinct(size_us), delay, slices, kinds="bigint")
    end = (floor_div(F.col("us"), size_us) + 1) * size_us
    return out.select(
        *keys, _time(end).alias("window_end"), F.when(F.col("visitor") != NOBODY, F.col("visitor")).alias("visitor"),
        _time("us").alias(ts), F.col("seq").alias(seq), F.col("n").alias("cnt"),
    )
