"""Chat formatting with minimum-cost role repair.

A legal conversation is an optional system turn, then user and assistant turns in alternation, user
first. Dynamic programming over this automaton finds, for the turns as they are, the cheapest choice
of merges (a turn joins the one before it), relabels (a turn gets another role) and insertions (an
empty turn goes before it). Of equally cheap choices that one is taken which has, at the first turn where
they differ, the earlier step in the order of ``_steps``.

Turns are numbered within their conversation and cut into parts at every multiple of ``PART``, whatever the
partitions they come in; a conversation of at most ``PART`` turns is one row. Each part gives a matrix of least
costs from every state before it to every state after it. From the last part backwards these give the least
costs to the end of the conversation (``to_go``) behind each part; with them a part's turns lead each state
before it to one state after it; these maps, taken forwards, fix the state before each part; then each part
is repaired and rendered on its own. A step is chosen by its cost and the costs to go, so the cuts cannot matter. No
conversation, however long, is gathered in one task, nor are turns that share a number. The parts of a
conversation, put together in their order, are its rendering.

Roles are compared in lower case without surrounding blanks; null and unknown roles have to be
relabelled. Null text is empty; a long text stays within its part. Turns with equal numbers go by role
and text, so repeated rows stand together; a null turn stands first. Rows with a null conv_id form one
conversation. Other columns do not matter, whatever their names. An empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from liftwork.llm import staging
from liftwork.llm.groups import batched, grouped

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = {"system": SYSTEM, "user": USER, "assistant": ASSISTANT}
NAMES = ("", "system", "user", "assistant")
LEGAL = {START: (SYSTEM, USER), SYSTEM: (USER,), USER: (ASSISTANT,), ASSISTANT: (USER,)}
MERGE, INSERT, RELABEL = 1, 2, 3
PART = 512
FAR = 1 << 40


def _steps(role: int | None) -> list[tuple[int, int, int, str, int | None]]:
    """(state before, state after, cost, action, inserted role) of a turn, the cheapest of each pair of states."""
    best: dict[tuple[int, int], tuple[int, int, str, int | None]] = {}
    for state in LEGAL:
        for to in (SYSTEM, USER, ASSISTANT):
            cost = 0 if to == role else RELABEL
            options = []
            if to in LEGAL[state]:
                options.append((cost, 0, "keep", None))
            if to == state:
                options.append((cost + MERGE, 1, "merge", None))
            options += [(cost + INSERT, 2, "insert", via) for via in LEGAL[state] if to in LEGAL[via]]
            if options:
                best[state, to] = min(options, key=lambda o: o[:2])
    return [(s, t, c, a, via) for (s, t), (c, _, a, via) in sorted(best.items())]


STEPS = {role: _steps(role) for role in (None, SYSTEM, USER, ASSISTANT)}


def advance(costs: list[int], role: int | None) -> list[int]:
    """Least costs of being in each state after one more turn."""
    after = [FAR] * 4
    for before, to, cost, _, _ in STEPS[role]:
        after[to] = min(after[to], costs[before] + cost)
    return after


def matrix(roles: list[int | None]) -> list[int]:
    """Least costs from each state (rows) to each state, flattened."""
    out: list[int] = []
    for state in range(4):
        costs = [0 if s == state else FAR for s in range(4)]
        for role in roles:
            costs = advance(costs, role)
        out += costs
    return out


def times(first: list[int], second: list[int]) -> list[int]:
    """The matrix of two stretches in a row."""
    return [min(min(first[4 * s + via] + second[4 * via + t] for via in range(4)), FAR) for s in range(4) for t in range(4)]


def behind(costs: list[int], to_go: list[int]) -> list[int]:
    """Least costs to the end from each state before a stretch, of its matrix and those behind it."""
    return [min(min(costs[4 * s + t] + to_go[t] for t in range(4)), FAR) for s in range(4)]


def ahead(roles: list[int | None], to_go: list[int]) -> list[list[int]]:
    """Least costs to the end from each state, before every turn and behind the last one."""
    out = [to_go]
    for role in reversed(roles):
        here = [FAR] * 4
        for before, to, cost, _, _ in STEPS[role]:
            here[before] = min(here[before], cost + out[-1][to])
        out.append(here)
    return out[::-1]


END = [0] * 4


def repair(roles: list[int | None], before: int = START, to_go: list[int] = END) -> list[tuple]:
    """The step of each turn on the cheapest way from ``before``, ``to_go`` being the costs behind the last turn."""
    left, state, out = ahead(roles, to_go), before, []
    for k, role in enumerate(roles):
        step = next(s for s in STEPS[role] if s[0] == state and s[2] + left[k + 1][s[1]] == left[k][state])
        out.append(step)
        state = step[1]
    return out


def ways(roles: list[int | None], to_go: list[int]) -> list[int]:
    """The state that each state before a part is led to."""
    left, out = ahead(roles, to_go), list(range(4))
    for k, role in enumerate(roles):
        led = {s: next(x[1] for x in STEPS[role] if x[0] == s and x[2] + left[k + 1][x[1]] == left[k][s]) for s in set(out)}
        out = [led[s] for s in out]
    return out


def render(steps: list[tuple], texts: list[str]) -> str:
    """The text of a part: markers open every turn, merged texts follow on a new line."""
    out = []
    for (before, to, _, action, via), text in zip(steps, texts, strict=True):
        if action == "merge":
            out.append(f"\n{text}")
            continue
        close = "" if before == START else "<|end|>\n"
        empty = f"<|{NAMES[via]}|>\n<|end|>\n" if action == "insert" else ""
        out.append(f"{close}{empty}<|{NAMES[to]}|>\n{text}")
    return "".join(out)


_OUT = pa.schema([("conv_id", pa.int64()), ("part", pa.int64()), ("cost", pa.int64()), ("n_turns", pa.int64()), ("n_merged", pa.int64()), ("n_relabelled", pa.int64()), ("n_inserted", pa.int64()), ("rendered", pa.string())])


def _numbered(given: DataFrame) -> DataFrame:
    """``given`` (conv_id, turn, role, text) with part and seq, from the number of the turn within its conversation.

    Range partitions are sorted and written with the place of each turn in its run, the rows of one conversation in one
    partition. The driver sees a row a partition and from it how many turns of a partition's first conversation came before.
    """
    order = ("conv_id", "turn", "role", "text", "_place")
    ordered = given.withColumn("_place", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    schema = pa.schema([("conv_id", pa.int64()), ("task", pa.int32()), ("run", pa.int64()), ("place", pa.int64()), ("role", pa.int32()), ("text", pa.string())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, last, number, place = TaskContext.get().partitionId(), None, -1, 0
        for batch in batches:
            runs, places = [], []
            for conv in batch.column("conv_id").to_pylist():
                if number < 0 or conv != last:
                    last, number, place = conv, number + 1, 0
                runs.append(number)
                places.append(place)
                place += 1
            arrays = [batch.column("conv_id"), pa.array([task] * len(runs), pa.int32()), pa.array(runs, pa.int64()), pa.array(places, pa.int64()), batch.column("role"), batch.column("text")]
            yield pa.RecordBatch.from_arrays(arrays, schema=schema)

    placed = staging.stored(ordered.select("conv_id", "role", "text").mapInArrow(run, "conv_id long, task int, run long, place long, role int, text string"), "chat-turns")
    ends = F.struct("run", "place", "conv_id")
    known = sorted(((r["task"], r["a"], r["z"]) for r in placed.groupBy("task").agg(F.min(ends).alias("a"), F.max(ends).alias("z")).collect()), key=lambda r: r[0])
    carried, open_, turns = [], None, 0
    for task, first, last in known:
        more = turns if open_ is not None and open_[0] == first["conv_id"] else 0
        carried.append((task, more))
        open_, turns = (last["conv_id"],), last["place"] + 1 + (more if last["run"] == 0 else 0)
    before = given.sparkSession.createDataFrame(carried, "task int, before long")
    turn = F.col("place") + F.when(F.col("run") == 0, F.col("before")).otherwise(0)
    return placed.join(F.broadcast(before), "task").select("conv_id", F.floor(turn / PART).alias("part"), F.pmod(turn, F.lit(PART)).cast("int").alias("seq"), "role", "text")


_COSTS, _KEYS = "array<long>", "conv_id long, part long"


def _schema(ddl: str) -> pa.Schema:
    kinds = {"long": pa.int64(), "int": pa.int32(), "array<long>": pa.list_(pa.int64())}
    return pa.schema([(name, kinds[kind]) for name, kind in (c.split(" ") for c in ddl.split(", "))])


def _each(rows_: DataFrame, by: list[str], order: list[str], found, ddl: str) -> DataFrame:
    """The rows that ``found`` gives for each group of rows with equal ``by``, in ``order``."""
    schema = _schema(ddl)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batched((x for key, group in grouped(batches, len(by)) for x in found(key, group)), schema)

    return rows_.repartition(*by).sortWithinPartitions(*by, *order).mapInArrow(run, ddl)


def _joined(left: DataFrame, right: DataFrame, keys: list[str]) -> DataFrame:
    """Equality join with NULL equal to NULL."""
    right = right.withColumnsRenamed({k: f"_{k}" for k in keys})
    return left.join(right, reduce(lambda x, y: x & y, (left[k].eqNullSafe(right[f"_{k}"]) for k in keys))).drop(*(f"_{k}" for k in keys))


def _stretch(parts: DataFrame) -> DataFrame:
    """``parts`` with stretch and place: PART parts are a stretch, so one row stands for PART * PART turns."""
    return parts.withColumns({"stretch": F.floor(F.col("part") / PART), "place": F.pmod("part", F.lit(PART))})


def _to_go(matrices: DataFrame) -> DataFrame:
    """(conv_id, part, to_go): the least costs to the end from each state behind every part (conv_id, part, costs)."""
    keys = "conv_id long, stretch long"
    given = staging.stored(_stretch(matrices).select("conv_id", "stretch", "place", "part", "costs"), "chat-costs")

    def product(key, group):
        yield *key, reduce(times, (r[4] for r in group))

    def stretches(key, group):
        to_go = END
        for r in reversed(group):
            yield r[0], r[1], to_go
            to_go = behind(r[2], to_go)

    def parts(key, group):
        to_go = group[0][5]
        for r in reversed(group):
            yield r[0], r[3], to_go
            to_go = behind(r[4], to_go)

    products = _each(given, ["conv_id", "stretch"], ["place"], product, f"{keys}, costs {_COSTS}")
    ends = _each(products, ["conv_id"], ["stretch"], stretches, f"{keys}, to_go {_COSTS}")
    whole = _joined(given, ends, ["conv_id", "stretch"]).select("conv_id", "stretch", "place", "part", "costs", "to_go")
    return _each(whole, ["conv_id", "stretch"], ["place"], parts, f"{_KEYS}, to_go {_COSTS}")


def _before(led: DataFrame) -> DataFrame:
    """(conv_id, part, before): the state before every part (conv_id, part, led), led: where each state before it leads."""
    keys = "conv_id long, stretch long"
    given = staging.stored(_stretch(led).select("conv_id", "stretch", "place", "part", "led"), "chat-led")

    def product(key, group):
        yield *key, reduce(lambda x, y: [y[s] for s in x], (r[4] for r in group))

    def stretches(key, group):
        state = START
        for r in group:
            yield r[0], r[1], state
            state = r[2][state]

    def parts(key, group):
        state = group[0][5]
        for r in group:
            yield r[0], r[3], state
            state = r[4][state]

    products = _each(given, ["conv_id", "stretch"], ["place"], product, f"{keys}, led {_COSTS}")
    starts = _each(products, ["conv_id"], ["stretch"], stretches, f"{keys}, first int")
    whole = _joined(given, starts, ["conv_id", "stretch"]).select("conv_id", "stretch", "place", "part", "led", "first")
    return _each(whole, ["conv_id", "stretch"], ["place"], parts, f"{_KEYS}, before int")


def formatted(turns: DataFrame) -> DataFrame:
    """(conv_id, part, cost, n_turns, n_merged, n_relabelled, n_inserted, rendered) of every part of every conversation."""
    role = F.trim(F.lower(F.col("role").cast("string")))
    code = F.coalesce(*(F.when(role == name, F.lit(k)) for name, k in ROLES.items()))
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    given = turns.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), code.alias("role"), text.alias("text"))
    table = _numbered(given)
    key = ["conv_id", "part"]

    def costs(key, group):
        yield *key, matrix([r[3] for r in group])

    def led(key, group):
        yield *key, ways([r[3] for r in group], group[0][4])

    def rendered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def each() -> Iterator[tuple]:
            for key, run in grouped(batches, 2):
                steps = repair([r[3] for r in run], run[0][5], run[0][6])
                relabelled = sum(s[1] != r[3] for s, r in zip(steps, run, strict=True))
                actions = [s[3] for s in steps]
                yield (*key, sum(s[2] for s in steps), len(run), actions.count("merge"), relabelled, actions.count("insert"), render(steps, [r[4] for r in run]))

        yield from batched(each(), _OUT, 500)

    roles = table.select(*key, "seq", "role")
    to_go = staging.stored(_to_go(_each(roles, key, ["seq"], costs, f"{_KEYS}, costs {_COSTS}")), "chat-to-go")
    known = _joined(roles, to_go, key).select(*key, "seq", "role", "to_go")
    before = _before(_each(known, key, ["seq"], led, f"{_KEYS}, led {_COSTS}"))
    ends = staging.stored(_joined(to_go, before, key).select(*key, "before", "to_go"), "chat-ends")
    whole = _joined(table, ends, key).select(*key, "seq", "role", "text", "before", "to_go")
    schema = "conv_id long, part long, cost long, n_turns long, n_merged long, n_relabelled long, n_inserted long, rendered string"
    return whole.repartition(*key).sortWithinPartitions(*key, "seq").mapInArrow(rendered, schema)


def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return formatted(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
