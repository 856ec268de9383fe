"""Conversation repair: cheapest edits to well-formed role sequences, by a Viterbi
search cut into pieces that run in parallel.

The turns of a conversation walk through four states (nothing yet, after a system
turn, after a user turn, after an assistant turn). What is left to pay from a row on
is a vector of four costs, computed from the end to the start. Only differences
within a vector decide, so vectors are kept less their minimum and are few; a
step is a lookup of (vector, kind of row).

A long conversation is cut into pieces of `PIECE_ROWS` rows. All pieces start at
the same time from a speculative vector (the one of a conversation's end). Fix-up passes
rerun the pieces whose right neighbour turned out to begin with another vector, and
stop within a piece as soon as old and new vectors differ by a constant only; passes
end when no piece has to be rerun. With the vectors known, every piece is traced from
all four states, the maps from entry to exit are chained, and the trace from the true entry
is kept: at each step the first letter in ASCII order that costs no more.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tallymark.functions.ordering import running_totals
from tallymark.llm.common import grouped_stream, positional, prepare, stored, table

#: Rows of a conversation that one piece holds.
PIECE_ROWS = 65_536

# Prices of the edits and what a truncated row that stays adds.
DELETE, INSERT, REROLE, TRUNCATED = 4, 3, 3, 3

START, SYSTEM, USER, ASSISTANT = range(4)
#: State after a user or assistant turn put in (insert, rerole) where the state allows one only.
ALTERNATE = (USER, USER, ASSISTANT, USER)
#: State after keeping a row whose role begins with s, u or a, where that is allowed.
KEPT = {(START, 0): SYSTEM, (START, 1): USER, (SYSTEM, 1): USER, (USER, 2): ASSISTANT, (ASSISTANT, 1): USER}
#: Kinds of row: 0-3 a role's initial s, u, a or other, plus 4 if truncated; 8 must be deleted.
MUST_GO = 8
END = (0, 6, 3, 0)
LEGAL = ((0, 1), (1, 2), (2, 1))

SPACE = r"\x20\x09-\x0D"


def _key(conv_id: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), conv_id.cast("string")), F.lit(""))


def _turns(conversations: DataFrame) -> DataFrame:
    """conv_id, key, turn, role, text; a null role or text is one space."""
    renamed, _, new = positional(conversations)
    conv = F.col(new["conv_id"])
    return renamed.select(
        conv.alias("conv_id"),
        _key(conv).alias("key"),
        F.col(new["turn"]).cast("bigint").alias("turn"),
        F.coalesce(F.col(new["role"]).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(new["text"]).cast("string"), F.lit(" ")).alias("text"),
    )


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text) with faults put in by the checksum of `conv_id:turn`, a null
    there being one space: every twentieth row is dropped, emptied, stripped of sentence
    ends, repeated, or becomes a user's. Null roles and texts become one space. Rows of
    one conversation and turn have the same fault. An empty table gives an empty one."""
    named = F.concat_ws(
        ":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.coalesce(F.col("turn").cast("string"), F.lit(" "))
    )
    rows = _turns(conversations).withColumn("fault", F.crc32(named.cast("binary")) % 20).filter("fault != 0")
    text = (
        F.when(F.col("fault") == 1, F.lit(""))
        .when(F.col("fault") == 2, F.regexp_replace("text", "[.!?]", ""))
        .otherwise(F.col("text"))
    )
    copies = F.sequence(F.lit(0), F.when(F.col("fault") == 3, 1).otherwise(0))
    role = F.when(F.col("fault") == 4, F.lit("user")).otherwise(F.col("role"))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")


def _digest() -> Column:
    return F.unhex(F.md5(F.concat_ws(":", F.length("role").cast("string"), "role", "text").cast("binary")))


def _marked(turns: DataFrame, piece_rows: int) -> DataFrame:
    """Rows without texts, in their conversation's order, with their fault (1 blank,
    2 duplicate, 3 truncated) and the piece they belong to."""
    initial = F.substring("role", 1, 1)
    slim = turns.select(
        "key", "turn", _digest().alias("digest"),
        F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3).alias("initial"),
        (~F.col("text").rlike(f"[^{SPACE}]")).alias("blank"),
        (~F.col("text").rlike(rf"[.!?][{SPACE}]*\z")).alias("cut"),
        F.lit(1).cast("bigint").alias("one"),
    )
    placed = running_totals(slim, ["turn", "digest"], ["one"], ("key",))
    placed = stored(placed.withColumnsRenamed({"before_one": "pos", "total_one": "n"}).drop("one"), "turns")
    firsts = placed.groupBy("key", "digest").agg(F.min("pos").alias("pos")).select("key", "pos", F.lit(True).alias("first"))
    fault = F.when(F.col("blank"), 1).when(F.col("first").isNull(), 2).when(F.col("cut"), 3).otherwise(0)
    return stored(
        placed.join(firsts, ["key", "pos"], "left")
        .withColumn("fault", fault)
        .select(
            "key", "pos", "turn", "digest", "initial", "fault", "n",
            F.floor(F.col("pos") / piece_rows).cast("bigint").alias("piece"),
            F.when(F.col("fault").isin(1, 2), MUST_GO)
            .otherwise(F.col("initial") + F.when(F.col("fault") == 3, 4).otherwise(0)).alias("kind"),
        ),
        "marked-turns",
    )


class Costs:
    """Steps over cost vectors, each computed once."""

    def __init__(self) -> None:
        self.steps: dict[tuple, tuple] = {}
        self.moves: dict[tuple, tuple] = {}

    @staticmethod
    def _direct(after: tuple, kind: int) -> list:
        out = []
        for state in range(4):
            best = DELETE + after[state]
            if kind != MUST_GO:
                more = TRUNCATED * (kind >= 4)
                best = min(best, more + REROLE + after[ALTERNATE[state]])
                kept = KEPT.get((state, kind % 4))
                if kept is not None:
                    best = min(best, more + after[kept])
            out.append(best)
        return out

    @staticmethod
    def _with_inserts(direct: list) -> tuple:
        user = min(direct[USER], INSERT + direct[ASSISTANT])
        assistant = min(direct[ASSISTANT], INSERT + direct[USER])
        return min(direct[START], INSERT + user), min(direct[SYSTEM], INSERT + user), user, assistant

    def before(self, after: tuple, kind: int) -> tuple:
        """Costs in front of a row, less their minimum."""
        found = self.steps.get((after, kind))
        if found is None:
            costs = self._with_inserts(self._direct(after, kind))
            found = self.steps[after, kind] = tuple(c - min(costs) for c in costs)
        return found

    def move(self, after: tuple, kind: int, state: int) -> tuple:
        """(letters, roles put in, what the row becomes, price, next state) of the
        cheapest edits up to and with this row; the least letters of equal ones."""
        found = self.moves.get((after, kind, state))
        if found is None:
            found = self.moves[after, kind, state] = self._move(after, kind, state)
        return found

    def _move(self, after: tuple, kind: int, state: int) -> tuple:
        left = self._with_inserts(self._direct(after, kind))
        letters, put_in, price = "", "", 0
        while True:
            if DELETE + after[state] == left[state]:
                return letters + "D", put_in, "", price + DELETE, state
            if INSERT + left[ALTERNATE[state]] == left[state]:
                state = ALTERNATE[state]
                letters, put_in, price = letters + "I", put_in + "ua"[state == ASSISTANT], price + INSERT
                continue
            more = TRUNCATED * (kind >= 4)
            kept = KEPT.get((state, kind % 4))
            if kept is not None and more + after[kept] == left[state]:
                return letters + "K", put_in, "k", price + more, kept
            state = ALTERNATE[state]
            return letters + "R", put_in, "ua"[state == ASSISTANT], price + more + REROLE, state

    @staticmethod
    def finish(state: int) -> tuple:
        """(letters, roles put in, price) after the last row."""
        put_in = {START: "", SYSTEM: "ua", USER: "a", ASSISTANT: ""}[state]
        return "I" * len(put_in), put_in, INSERT * len(put_in)


PIECES = (
    "key string, piece bigint, n bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
    "first_initial int, last_initial int, first_turn bigint, last_turn bigint, low bigint, high bigint, "
    "turns bigint, start array<int>"
)


def _column(rows: pa.Table, name: str) -> np.ndarray:
    return rows.column(name).to_numpy()


def _summaries(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
    """Per piece its counts, what its neighbours must know, and its first vector if
    the conversation ended behind it."""
    kinds, fault, initial = _column(rows, "kind").tolist(), _column(rows, "fault"), _column(rows, "initial")
    first, last = starts[:-1], starts[1:] - 1
    legal = np.zeros((4, 4), bool)
    for a, b in LEGAL:
        legal[a, b] = True
    broken = np.zeros(len(fault), np.int64)
    broken[1:] = ~legal[initial[:-1], initial[1:]]
    broken[first] = 0
    turn = rows.column("turn").combine_chunks()
    known = turn.is_valid().to_numpy(zero_copy_only=False)
    number = turn.fill_null(0).to_numpy()
    new = known.astype(np.int64)
    new[1:] -= known[1:] & known[:-1] & (number[1:] == number[:-1])
    new[first] = 0  # whether a piece's first turn is new is told by the piece before
    costs = Costs()
    vectors = []
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        vector = END
        for kind in reversed(kinds[lo:hi]):
            vector = costs.before(vector, kind)
        vectors.append(list(vector))
    ends = turn.take(pa.array(last))
    least, most = [], []
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        some = number[lo:hi][known[lo:hi]]
        least.append(int(some.min()) if len(some) else None)
        most.append(int(some.max()) if len(some) else None)
    summed = lambda x: np.add.reduceat(x.astype(np.int64), first)
    return pa.RecordBatch.from_arrays(
        [
            rows.column("key").take(pa.array(first)).combine_chunks(), rows.column("piece").take(pa.array(first)).combine_chunks(),
            rows.column("n").take(pa.array(first)).combine_chunks(),
            *[pa.array(x) for x in (summed(fault == 1), summed(fault == 2), summed(fault == 3), summed(broken))],
            pa.array(initial[first].astype(np.int32)), pa.array(initial[last].astype(np.int32)),
            turn.take(pa.array(first)), ends, pa.array(least, pa.int64()), pa.array(most, pa.int64()),
            pa.array(summed(new)), pa.array(vectors, pa.list_(pa.int32())),
        ],
        names=[c.split()[0] for c in PIECES.split(", ")],
    )


def _vector(column, at: int) -> tuple:
    return tuple(column[at].as_py())


def _rerun(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
    """First vectors of pieces whose right end differs from the one used before.
    Old and new run side by side until they agree; from there on nothing changes."""
    kinds, costs, out = _column(rows, "kind").tolist(), Costs(), []
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        old, new = _vector(rows.column("used"), lo), _vector(rows.column("wanted"), lo)
        for kind in reversed(kinds[lo:hi]):
            if old == new:
                break
            old, new = costs.before(old, kind), costs.before(new, kind)
        out.append(_vector(rows.column("start"), lo) if old == new else new)
    at = pa.array(starts[:-1])
    return pa.RecordBatch.from_arrays(
        [rows.column("key").take(at).combine_chunks(), rows.column("piece").take(at).combine_chunks(),
         pa.array([list(v) for v in out], pa.list_(pa.int32()))],
        names=["key", "piece", "again"],
    )


def _vectors_after(costs: Costs, kinds: list, last: tuple) -> list:
    """The vector behind each row."""
    out = [last] * len(kinds)
    for i in range(len(kinds) - 1, 0, -1):
        out[i - 1] = costs.before(out[i], kinds[i])
    return out


def _exits(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
    """The state behind each piece for each state in front of it."""
    kinds, costs, out = _column(rows, "kind").tolist(), Costs(), []
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        after = _vectors_after(costs, kinds[lo:hi], _vector(rows.column("used"), lo))
        states = list(range(4))
        for vector, kind in zip(after, kinds[lo:hi]):
            states = [costs.move(vector, kind, s)[4] for s in states]
        out.append(states)
    at = pa.array(starts[:-1])
    return pa.RecordBatch.from_arrays(
        [rows.column("key").take(at).combine_chunks(), rows.column("piece").take(at).combine_chunks(),
         pa.array(out, pa.list_(pa.int32()))],
        names=["key", "piece", "exits"],
    )


def _entries(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
    """The state in front of each piece; a group holds the pieces of a conversation."""
    out = np.zeros(rows.num_rows, np.int32)
    exits = rows.column("exits").to_pylist()
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        state = START
        for i in range(lo, hi):
            out[i] = state
            state = exits[i][state]
    return pa.RecordBatch.from_arrays(
        [rows.column("key").combine_chunks(), rows.column("piece").combine_chunks(), pa.array(out)],
        names=["key", "piece", "entry"],
    )


EDITS = "key string, pos bigint, digest binary, letters string, put_in string, becomes string, price bigint"


def _trace(rows: pa.Table, starts: np.ndarray) -> pa.RecordBatch:
    """The edits at each row, and behind a conversation's last one."""
    kinds, n, piece_end = _column(rows, "kind").tolist(), _column(rows, "n"), _column(rows, "pos")
    costs, moves, order = Costs(), [], []
    for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist()):
        last = rows.column("used")[lo].as_py()
        after = _vectors_after(costs, kinds[lo:hi], END if last is None else tuple(last))
        state = rows.column("entry")[lo].as_py() or START
        for i, vector in enumerate(after):
            *move, state = costs.move(vector, kinds[lo + i], state)
            moves.append((*move, False))
            order.append(lo + i)
        if piece_end[hi - 1] == n[hi - 1] - 1 and costs.finish(state)[0]:
            letters, put_in, price = costs.finish(state)
            moves.append((letters, put_in, "", price, True))
            order.append(hi - 1)
    letters, put_in, becomes, price, behind = zip(*moves)
    at = pa.array(order)
    behind = np.array(behind)
    digest = rows.column("digest").take(at).combine_chunks()
    return pa.RecordBatch.from_arrays(
        [rows.column("key").take(at).combine_chunks(), pa.array(piece_end[order] + behind), digest,
         pa.array(letters), pa.array(put_in), pa.array(becomes), pa.array(np.array(price, np.int64))],
        names=[c.split()[0] for c in EDITS.split(", ")],
    )


def _long(pieces: DataFrame, marked: DataFrame, piece_rows: int) -> DataFrame | None:
    """(key, piece, used, entry) for the pieces of conversations that have several:
    the vector behind each piece and the state in front of it. None if there are none."""
    last = F.floor((F.col("n") - 1) / piece_rows).cast("bigint")
    end = F.array(*[F.lit(c) for c in END])
    state = stored(
        pieces.withColumn("last", last).filter("last > 0").select("key", "piece", "last", end.alias("used"), "start"), "pieces"
    )
    if state.isEmpty():
        return None
    along = Window.partitionBy("key").orderBy("piece")
    rows = marked.select("key", "piece", "pos", "kind")
    while True:
        wanted = F.when(F.col("piece") == F.col("last"), end).otherwise(F.lead("start").over(along))
        stale = stored(state.withColumn("wanted", wanted).filter("wanted != used").drop("last"), "stale")
        if stale.isEmpty():
            break
        again = grouped_stream(
            rows.join(stale, ["key", "piece"]), ["key", "piece"], "key string, piece bigint, again array<int>", _rerun, ["pos"]
        )
        changed = stale.select("key", "piece", "wanted").join(again, ["key", "piece"])
        state = stored(
            state.join(changed, ["key", "piece"], "left").select(
                "key", "piece", "last", F.coalesce("wanted", "used").alias("used"), F.coalesce("again", "start").alias("start")
            ),
            "pieces",
        )
    exits = grouped_stream(
        rows.join(state.select("key", "piece", "used"), ["key", "piece"]), ["key", "piece"],
        "key string, piece bigint, exits array<int>", _exits, ["pos"],
    )
    entries = grouped_stream(exits, ["key"], "key string, piece bigint, entry int", _entries, ["piece"])
    return stored(state.select("key", "piece", "used").join(entries, ["key", "piece"]), "entries")


def _faults(pieces: DataFrame) -> DataFrame:
    """Counts per conversation; what lies between two pieces is added from their borders."""
    along = Window.partitionBy("key").orderBy("piece")
    before = F.lag("last_initial").over(along)
    legal = [(before == a) & (F.col("first_initial") == b) for a, b in LEGAL]
    new_turn = F.col("first_turn").isNotNull() & ~F.col("first_turn").eqNullSafe(F.lag("last_turn").over(along))
    bordered = pieces.withColumn(
        "illegal", F.col("illegal") + F.when(before.isNotNull() & ~(legal[0] | legal[1] | legal[2]), 1).otherwise(0)
    ).withColumn("turns", F.col("turns") + new_turn.cast("int"))
    gaps = F.max("high") - F.min("low") + 1 - F.sum("turns")
    return bordered.groupBy("key").agg(
        F.coalesce(gaps, F.lit(0)).cast("bigint").alias("gaps"),
        *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal")],
    )


def repair_edits(turns: DataFrame, piece_rows: int = PIECE_ROWS) -> tuple[DataFrame, DataFrame]:
    """(edits, faults) of `turns` as `_turns` gives them: a row per turn, and one behind
    the last where turns are added there; and counts per conversation."""
    prepare(turns.sparkSession)
    marked = _marked(turns, piece_rows)
    pieces = stored(
        grouped_stream(
            marked.select("key", "piece", "pos", "kind", "fault", "initial", "turn", "n"), ["key", "piece"], PIECES, _summaries, ["pos"]
        ),
        "pieces",
    )
    long = _long(pieces, marked, piece_rows)
    rows = marked.select("key", "piece", "pos", "kind", "n", "digest")
    if long is None:
        rows = rows.withColumns({"used": F.lit(None).cast("array<int>"), "entry": F.lit(0)})
    else:
        rows = rows.join(long, ["key", "piece"], "left")
    return stored(grouped_stream(rows, ["key", "piece"], EDITS, _trace, ["pos"]), "edits"), _faults(pieces)


def _repaired(turns: DataFrame, edits: DataFrame) -> DataFrame:
    """The edits with the role and text of rows that stay. A text is needed once per
    conversation, since repetitions are deleted."""
    said = turns.withColumn("digest", _digest()).groupBy("key", "digest").agg(
        F.first("role").alias("role"), F.first("text").alias("text")
    )
    stay = edits.filter("becomes != ''").join(said, ["key", "digest"]).drop("digest")
    role = F.when(F.col("becomes") == "u", "user").when(F.col("becomes") == "a", "assistant").otherwise(F.col("role"))
    gone = edits.filter("becomes = ''").drop("digest")
    nothing = F.lit(None).cast("string")
    return stay.withColumn("role", role).unionByName(gone.withColumns({"role": nothing, "text": nothing}))


def repair_conversations(conversations: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Repaired turns: conv_id, position (from 1), edit (K kept, R new role, I put in),
    role, text. The cheapest edits that make each conversation's roles an optional system turn
    and then user and assistant in turn; blank and repeated turns go.

    Turns follow `turn` (nulls first), equal ones the digest of role and text. A null role or
    text is one space; a null conv_id is a conversation of its own. A conversation of which
    nothing is left has no row; an empty table gives an empty result. Other columns are ignored."""
    turns = _turns(conversations)
    edits, _ = repair_edits(turns, piece_rows)
    whole = _repaired(turns, edits)
    names = turns.select("key", "conv_id").distinct()
    put_in = F.transform(
        F.filter(F.split("put_in", ""), lambda c: c != ""),
        lambda c: F.struct(F.lit("I").alias("edit"), F.when(c == "u", "user").otherwise("assistant").alias("role"), F.lit("").alias("text")),
    )
    own = F.struct(F.when(F.col("becomes") == "k", "K").otherwise("R").alias("edit"), "role", "text")
    out = whole.withColumn("turn", F.when(F.col("becomes") == "", put_in).otherwise(F.concat(put_in, F.array(own))))
    listed = out.select("key", "pos", F.posexplode("turn").alias("sub", "turn")).withColumn("one", F.lit(1).cast("bigint"))
    numbered = running_totals(listed, ["pos", "sub"], ["one"], ("key",))
    return numbered.join(names, "key").select("conv_id", (F.col("before_one") + 1).alias("position"), "turn.*")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Audit, cost and digest per conversation; rows come in order, lines are never held."""
    key, sha, audit, cost, empty = None, hashlib.sha256(), [], 0, True
    done: list[tuple] = []

    def pack():
        cols = list(zip(*done)) if done else [[], [], [], []]
        done.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64()), pa.array(cols[3], pa.string())],
            names=["key", "audit", "cost", "repaired_sha256"],
        )

    for batch in batches:
        for of, letters, price, lines in zip(*[batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("key", "letters", "price", "lines")]):
            if of != key:
                if key is not None:
                    done.append((key, "".join(audit), cost, sha.hexdigest()))
                key, sha, audit, cost, empty = of, hashlib.sha256(), [], 0, True
            audit.append(letters)
            cost += price
            if lines:
                sha.update((lines[1:] if empty else lines).encode())
                empty = False
        yield pack()
    if key is not None:
        done.append((key, "".join(audit), cost, sha.hexdigest()))
    yield pack()


def repair_audit(conversations: DataFrame, piece_rows: int = PIECE_ROWS) -> DataFrame:
    """Per conversation: gaps, blank, duplicate, truncated, illegal, cost, audit and the digest
    of the repaired turns. Nulls, ties and repeated rows as in `repair_conversations`; an empty table
    gives an empty result."""
    turns = _turns(conversations)
    edits, faults = repair_edits(turns, piece_rows)
    put_in = F.array_join(
        F.transform(F.split("put_in", ""), lambda c: F.when(c == "u", "\nuser:").when(c == "a", "\nassistant:").otherwise("")), ""
    )
    own = F.when(F.col("becomes") == "", F.lit("")).otherwise(F.concat(F.lit("\n"), "role", F.lit(":"), "text"))
    lines = _repaired(turns, edits).select("key", "pos", "letters", "price", F.concat(put_in, own).alias("lines"))
    told = lines.repartition("key").sortWithinPartitions("key", "pos").mapInArrow(
        _digests, "key string, audit string, cost bigint, repaired_sha256 string"
    )
    return faults.join(told, "key")


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """`conversations` with faults put in, repaired. One row per original conv_id (null is one
    of them); without rows after the damage zeros, an empty audit and the digest of nothing."""
    conversations = table(spark, sf_dir, "conversations")
    told = repair_audit(damage(conversations))
    names = _turns(conversations).select("conv_id", "key").distinct()
    zero = {c: F.coalesce(c, F.lit(0)).cast("bigint") for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")}
    nothing = hashlib.sha256(b"").hexdigest()
    return names.join(told, "key", "left").select(
        "conv_id", *[x.alias(c) for c, x in zero.items()],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256"),
    )
