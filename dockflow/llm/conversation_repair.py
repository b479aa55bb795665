"""Cheapest repair of conversations' turn structure, by prefix-doubling path ranking.

A conversation is good if its roles read (system)? (user assistant)+, or if it has
no turn. Edits make it so: Keep a turn (0), Rerole it to user or assistant (2),
Delete it (3; blank and repeated turns must go), Insert an empty turn (2); a
truncated turn that stays adds 1. Among the cheapest edits the ones whose initials
are ASCII-least are taken: the audit.

Nodes are (turns read, what was written last: nothing, system, user, assistant),
arcs are edits. No conversation has to fit a task:

1. Turns are put in order by a range partitioning and cut into blocks of at most
   ``BLOCK`` turns of one conversation.
2. Cost DP. Each block gives the least costs from every state before it to every
   state after it, 4 x 4 numbers. Products of 2^j blocks by doubling joins give the
   cost to go behind each block; with it the block finds which arcs are optimal.
3. Path ranking in the block: each node points along its optimal arc of least
   initial (those of one node always differ). Ranks by the first 1, 2, 4, ...
   initials and pointers over as many arcs are doubled together. Nodes of equal
   final rank have equal audits, so an audit is read off, through the doubled
   pointers, once for each rank.
4. Which state a block starts in follows from the pointers over 2^j blocks, doubled
   by joins again.

Only conversations of more than one block take part in the joins of 2 and 4.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockflow.llm.base import map_batches, map_stream, settle
from dockflow.operators.sequence import with_rank

REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Turns of a block, and turns that are worked on at once.
BLOCK_BITS = 10
CELLS = 1 << 16
#: White space is these six characters alone.
SPACE = " \t\n\x0b\x0c\r"
FAR = 1 << 40
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
INITIALS = "sua"  # of the roles that states 1 to 3 are reached by
#: A turn's code: 4 x its role's state (0: another role) + 2 if it must go + 1 if it is truncated.
PAD = 16
#: What is still needed behind the last turn: an assistant's turn, or both.
END = np.array([0, 2 * INSERT, INSERT, 0], np.int64)
TAIL = ["", "II", "I", ""]


def _costs() -> tuple[np.ndarray, ...]:
    """By code: cost and initial of writing a turn as system, user, assistant."""
    cost, label = np.full((3, PAD), FAR, np.int64), np.zeros((3, PAD), np.uint8)
    for code in range(PAD):
        state, must_go, truncated = code >> 2, code >> 1 & 1, code & 1
        if must_go:
            continue
        for to in (SYSTEM, USER, ASSISTANT):
            if state == to:
                cost[to - 1, code], label[to - 1, code] = TRUNCATED * truncated, ord("K")
            elif to != SYSTEM:
                cost[to - 1, code], label[to - 1, code] = REROLE + TRUNCATED * truncated, ord("R")
    return (*cost, *label)


AS_SYSTEM, AS_USER, AS_ASSISTANT, _, USER_LABEL, ASSISTANT_LABEL = _costs()
AFTER_INSERT = np.array([USER, USER, ASSISTANT, USER])


def transfer(codes: np.ndarray) -> np.ndarray:
    """Least costs of blocks (a row each, ``PAD`` behind the end) from each state before to each state after: [block, from, to]."""
    c = np.full((len(codes), 4, 4), FAR, np.int64)
    c[:, range(4), range(4)] = 0
    for i in range(codes.shape[1]):
        code = codes[:, i]
        live = (code < PAD)[:, None, None]
        code = np.minimum(code, PAD - 1)
        some = c.copy()
        some[:, :, USER] = np.minimum(c[:, :, USER], c[:, :, [NOTHING, SYSTEM, ASSISTANT]].min(axis=2) + INSERT)
        some[:, :, ASSISTANT] = np.minimum(c[:, :, ASSISTANT], some[:, :, USER] + INSERT)
        new = some + DELETE
        new[:, :, SYSTEM] = np.minimum(new[:, :, SYSTEM], some[:, :, NOTHING] + AS_SYSTEM[code][:, None])
        new[:, :, USER] = np.minimum(new[:, :, USER], some[:, :, [NOTHING, SYSTEM, ASSISTANT]].min(axis=2) + AS_USER[code][:, None])
        new[:, :, ASSISTANT] = np.minimum(new[:, :, ASSISTANT], some[:, :, USER] + AS_ASSISTANT[code][:, None])
        c = np.where(live, np.minimum(new, FAR), c)
    return c


def optimal_arcs(codes: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cost to go at the start, and each node's optimal arc of least initial.

    ``after``: cost to go behind each block. Nodes are numbered block by block,
    turn by turn, state by state; those behind the last turn point to themselves
    and have initial 0.
    """
    n, size = codes.shape
    node = np.arange(n * (size + 1) * 4).reshape(n, size + 1, 4)
    target = node.copy()
    label = np.zeros((n, size + 1, 4), np.uint8)
    g = after.astype(np.int64)
    for i in range(size - 1, -1, -1):
        live = codes[:, i] < PAD
        code = np.minimum(codes[:, i], PAD - 1)
        take = np.full((3, n, 4), FAR, np.int64)  # written as system, user, assistant
        take[0, :, NOTHING] = AS_SYSTEM[code] + g[:, SYSTEM]
        for q in (NOTHING, SYSTEM, ASSISTANT):
            take[1, :, q] = AS_USER[code] + g[:, USER]
        take[2, :, USER] = AS_ASSISTANT[code] + g[:, ASSISTANT]
        drop = DELETE + g
        h = np.minimum(drop, take.min(axis=0))
        now = h.copy()
        now[:, USER] = np.minimum(h[:, USER], INSERT + h[:, ASSISTANT])
        now[:, ASSISTANT] = np.minimum(h[:, ASSISTANT], INSERT + h[:, USER])
        for q in (NOTHING, SYSTEM):
            now[:, q] = np.minimum(h[:, q], INSERT + now[:, USER])
        # From the greatest initial to the least, so that the least optimal one stays.
        kinds = (np.full(n, ord("K"), np.uint8), USER_LABEL[code], ASSISTANT_LABEL[code])
        arcs = [(take[k], np.where(kind == ord(letter), kind, 0)[:, None], node[:, i + 1, k + 1][:, None]) for letter in "RK" for k, kind in enumerate(kinds)]
        arcs.append((INSERT + now[:, AFTER_INSERT], np.uint8(ord("I")), node[:, i, AFTER_INSERT]))
        arcs.append((drop, np.uint8(ord("D")), node[:, i + 1]))
        for cost, letter, to in arcs:
            ok = (cost == now) & (now < FAR) & live[:, None] & (letter != 0)
            target[:, i] = np.where(ok, to, target[:, i])
            label[:, i] = np.where(ok, letter, label[:, i])
        g = np.where(live[:, None], now, g)  # a block that ends before this turn has nothing to add yet
    return g, target, label


def rank_paths(target: np.ndarray, label: np.ndarray, longest: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """Ranks of the nodes' audits, and the pointers over 1, 2, 4, ... arcs that reach ``longest`` ones."""
    rank, jumps = np.unique(label.ravel(), return_inverse=True)[1].astype(np.int64), [target.ravel()]
    while 1 << (len(jumps) - 1) < longest:
        jump = jumps[-1]
        rank = np.unique(rank * (rank.max() + 1) + rank[jump], return_inverse=True)[1]
        jumps.append(jump[jump])
    return rank, jumps


def audits_of(nodes: np.ndarray, jumps: list[np.ndarray], label: np.ndarray) -> list[str]:
    """The audits from ``nodes``: all places of a path by halving, each from the one before through a doubled pointer."""
    at = nodes[:, None]
    for jump in reversed(jumps):
        at = np.stack([at, jump[at]], axis=2).reshape(len(nodes), -1)
    return [bytes(x).rstrip(b"\0").decode() for x in label.ravel()[at]]


def _padded(cells: list[list[int]]) -> np.ndarray:
    out = np.full((len(cells), max(map(len, cells))), PAD, np.uint8)
    for r, c in enumerate(cells):
        out[r, :len(c)] = c
    return out


def _alike(sizes: list[int]) -> Iterator[list[int]]:
    """Rows of like size, so many that padded they have ``CELLS`` cells at most (or are one row)."""
    some: list[int] = []
    for k in sorted(range(len(sizes)), key=sizes.__getitem__):
        if some and (len(some) + 1) * sizes[k] > CELLS:
            yield some
            some = []
        some.append(k)
    if some:
        yield some


def _transfers(batch: pa.RecordBatch) -> pa.RecordBatch:
    cells = batch.column(1).to_pylist()
    out = np.empty((len(cells), 16), np.int64)
    for some in _alike([len(c) for c in cells]):
        out[some] = transfer(_padded([cells[k] for k in some])).reshape(-1, 16)
    return pa.RecordBatch.from_arrays([batch.column(0), pa.array(list(out), pa.list_(pa.int64()))], ["r", "m"])


def _paths(batch: pa.RecordBatch) -> pa.RecordBatch:
    """Per block: cost to go before it, and for each state before it the audit and the state after."""
    cells, after = batch.column(1).to_pylist(), np.array(batch.column(2).to_pylist(), np.int64).reshape(-1, 4)
    before = np.empty((len(cells), 4), np.int64)
    audits: list[list[str]] = [[]] * len(cells)
    exits = np.empty((len(cells), 4), np.int64)
    for some in _alike([len(c) for c in cells]):
        codes = _padded([cells[k] for k in some])
        before[some], target, label = optimal_arcs(codes, after[some])
        rank, jumps = rank_paths(target, label, 3 * codes.shape[1] + 1)
        starts = target.shape[1] * 4 * np.arange(len(some))[:, None] + np.arange(4)
        _, one, same = np.unique(rank[starts].ravel(), return_index=True, return_inverse=True)
        texts = audits_of(starts.ravel()[one], jumps, label)
        named = same.reshape(-1, 4)
        end = starts
        for jump in jumps:
            end = jump[end]
        exits[some] = end % 4
        for r, k in enumerate(some):
            audits[k] = [texts[x] for x in named[r]]
    cols = [batch.column(0), pa.array(list(before), pa.list_(pa.int64())), pa.array(audits, pa.list_(pa.string())), pa.array(list(exits), pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(cols, ["r", "before", "audits", "exits"])


def _doubled(rows: DataFrame, longest: int, step: int, combine, name: str) -> DataFrame:
    """``rows`` (conv, r, v), where each v is combined with those of all its conversation's rows on the side of ``step``.

    Round j joins a row with the one 2^j places on; ``longest``: rows of the longest conversation.
    """
    reach = 1
    while reach < longest:
        other = rows.select(F.col("conv").alias("_conv"), (F.col("r") - step * reach).alias("_r"), F.col("v").alias("_v"))
        both = rows.join(other, (F.col("r") == F.col("_r")) & F.col("conv").eqNullSafe(F.col("_conv")), "left")
        rows = settle(both.select("conv", "r", F.when(F.col("_v").isNull(), F.col("v")).otherwise(combine(F.col("v"), F.col("_v"))).alias("v")), f"{name}-{reach}")
        reach *= 2
    return rows


def _product(a, b):
    """4 x 4 costs of two stretches of turns, one behind the other."""
    return F.array(*[F.least(*[a[4 * i + k] + b[4 * k + j] for k in range(4)], F.lit(FAR)) for i in range(4) for j in range(4)])


def _then(late, early):
    """The state after both stretches, by the state before them."""
    return F.transform(early, lambda q: F.get(late, q.cast("int")))


def _neighbour(blocks: DataFrame, rows: DataFrame, offset: int, value, name: str) -> DataFrame:
    """``blocks`` with ``value`` of the row ``offset`` places on in the same conversation, or null."""
    other = rows.select(F.col("conv").alias("_conv"), (F.col("r") - offset).alias("_r"), value.alias(name))
    return blocks.join(other, (F.col("r") == F.col("_r")) & F.col("conv").eqNullSafe(F.col("_conv")), "left").drop("_conv", "_r")


#: A turn's place: the columns that its conversation is sorted by.
PLACE = ["turn", "role", "digest", "uid"]


@dataclass
class Repair:
    """What :func:`repair` found; each table is built when asked for."""

    rows: DataFrame  # conv, turn, role, text, uid
    order: DataFrame  # conv, PLACE, pos, blank, duplicate, truncated, code
    blocks: DataFrame  # conv, r, head (place of the first turn), uids, codes, cost, entry, audit (with the tail of the last block)

    def summary(self) -> DataFrame:
        """``(conv_id, gaps, blank, duplicate, truncated, illegal, cost)``, a row for each conversation with turns."""
        turns = self.order.groupBy("conv", "turn").agg(*[F.sum(F.col(c).cast("long")).alias(c) for c in ("blank", "duplicate", "truncated")])
        span = F.max("turn") - F.min("turn") + 1 - F.count("turn")  # a row for each turn number
        faults = turns.groupBy("conv").agg(F.coalesce(span, F.lit(0)).cast("long").alias("gaps"), *[F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated")])
        costs = self.blocks.groupBy(F.col("conv").alias("_conv")).agg(F.sum("illegal").alias("illegal"), F.sum("cost").alias("cost"))
        both = faults.join(costs, F.col("conv").eqNullSafe(F.col("_conv")))
        return both.select(F.col("conv").alias("conv_id"), "gaps", "blank", "duplicate", "truncated", "illegal", "cost")

    def turns(self) -> DataFrame:
        """``(conv_id, block, place, edit, role, text)``: every edit in order; without those of edit D it is the repaired conversation."""
        edits = map_batches(self.blocks.select("r", "uids", "codes", "entry", "audit"), _edits, "block int, place int, uid long, edit string, written string")
        convs = self.blocks.select(F.col("r").alias("block"), F.col("conv").alias("conv_id"))
        texts = self.rows.select("uid", "role", "text")
        role = F.coalesce("written", "role").alias("role")
        return edits.join(convs, "block").join(texts, "uid", "left").select("conv_id", "block", "place", "edit", role, F.coalesce("text", F.lit("")).alias("text"))

    def digests(self) -> DataFrame:
        """``(conv_id, audit, repaired_sha256)``: initials of the edits, and the hash of the ``role:text`` lines left.

        A hash goes over a conversation's text from first to last, so one task
        streams it, holding a turn at a time and the audit.
        """
        kind = self.rows.schema["conv"].dataType.simpleString()
        texts = self.rows.select("conv", *PLACE, F.lit(1).alias("kind"), "text", F.lit(None).cast("string").alias("audit"))
        heads = self.blocks.select("conv", *[F.col(f"head.{c}").alias(c) for c in PLACE], F.lit(0).alias("kind"), F.lit(None).cast("string").alias("text"), "audit")
        dealt = texts.unionByName(heads).repartition("conv").sortWithinPartitions("conv", *PLACE, "kind")
        return map_stream(dealt.select("conv", "role", "kind", "text", "audit"), _hashes(kind), f"conv_id {kind}, audit string, repaired_sha256 string")


ROLES = ["", "system", "user", "assistant"]


def _edits(batch: pa.RecordBatch) -> pa.RecordBatch:
    out: list[tuple] = []
    for r, uids, codes, state, audit in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
        at = 0
        for place, edit in enumerate(audit):
            uid = None
            if edit != "I":
                uid, code = uids[at], codes[at]
                at += 1
            if edit == "D":
                out.append((r, place, uid, edit, None))
            else:
                state = code >> 2 if edit == "K" else int(AFTER_INSERT[state])
                out.append((r, place, uid, edit, None if edit == "K" else ROLES[state]))
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.string()]
    return pa.RecordBatch.from_arrays([pa.array([x[k] for x in out], kind) for k, kind in enumerate(kinds)], ["block", "place", "uid", "edit", "written"])


def _hashes(kind: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterable[pa.RecordBatch]:
        conv, begun = None, False
        state, empty, audits, edits, at, sha = NOTHING, True, [], "", 0, hashlib.sha256()
        done: list[tuple] = []
        conv_type = pa.int64()

        def line(text: str) -> None:
            nonlocal empty
            sha.update((text if empty else "\n" + text).encode(errors="surrogatepass"))
            empty = False

        def insert() -> None:  # the inserts that stand next in the block's audit
            nonlocal state, at
            while at < len(edits) and edits[at] == "I":
                state = int(AFTER_INSERT[state])
                line(ROLES[state] + ":")
                at += 1

        def flush() -> pa.RecordBatch:
            batch = pa.RecordBatch.from_arrays([pa.array([d[0] for d in done], conv_type), pa.array([d[1] for d in done], pa.string()), pa.array([d[2] for d in done], pa.string())], ["conv_id", "audit", "repaired_sha256"])
            done.clear()
            return batch

        for batch in batches:
            conv_type = batch.column(0).type
            for c, role, what, text, audit in zip(*(x.to_pylist() for x in batch.columns), strict=True):
                if not begun or c != conv:
                    if begun:
                        done.append((conv, "".join(audits), sha.hexdigest()))
                    conv, begun = c, True
                    state, empty, audits, edits, at, sha = NOTHING, True, [], "", 0, hashlib.sha256()
                if what == 0:
                    edits, at = audit, 0
                    audits.append(audit)
                else:
                    edit = edits[at]
                    at += 1
                    if edit == "K":
                        state = 1 + INITIALS.index(role[0])
                        line(f"{role}:{text}")
                    elif edit == "R":
                        state = int(AFTER_INSERT[state])
                        line(f"{ROLES[state]}:{text}")
                insert()  # before the next turn, or behind the last
            if len(done) >= 4096:
                yield flush()
        if begun:
            done.append((conv, "".join(audits), sha.hexdigest()))
        if done:
            yield flush()

    return run


def _ordered(rows: DataFrame) -> DataFrame:
    """Turns without their texts, with a number ``pos`` that grows in the order of conversations and turns, faults and codes."""
    stripped = F.rtrim("text", F.lit(SPACE))
    blank = F.length(stripped) == 0
    short = rows.select("conv", "turn", "role", F.col("digest"), "uid", blank.alias("blank"), (~F.substring(stripped, -1, 1).isin(".", "!", "?")).alias("open"))
    place = [F.col(c).asc_nulls_first() for c in ("conv", *PLACE)]
    placed = settle(short.repartitionByRange(*place).sortWithinPartitions(*place).withColumn("pos", F.monotonically_increasing_id()), "turn-order")
    first = placed.where(~F.col("blank")).groupBy("conv", "role", "digest").agg(F.min("pos").alias("pos")).select("pos", F.lit(True).alias("first"))
    known = placed.join(first, "pos", "left")
    duplicate = ~F.col("blank") & F.col("first").isNull()
    truncated = F.col("open") & ~F.col("blank") & ~duplicate
    initial = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))  # 0: another role
    state = F.when(F.length("role") == 0, 0).otherwise(initial)
    code = 4 * state + 2 * (F.col("blank") | duplicate).cast("int") + truncated.cast("int")
    return known.select("conv", *PLACE, "pos", "blank", duplicate.alias("duplicate"), truncated.alias("truncated"), code.cast("int").alias("code"))


def repair(rows: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> Repair:
    """The cheapest good form of every conversation of ``rows``.

    Turns go by ``turn`` (nulls first), those of one turn by role, then by the
    SHA-256 of their text; repeated rows stay side by side, and all but the first are
    duplicates. A null role or text is one space, a null conversation id is a
    conversation. A role counts by its first letter s, u or a; any other, an
    empty one too, must be changed or go. A turn's first fault counts: blank (no
    character but white space), duplicate (role and text seen earlier in the
    conversation), truncated (the last such character is none of ``.!?``).
    Illegal are neighbours, before the repair, other than su, ua, au. An empty
    table gives empty ones; extra columns are not read.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(" "))
    own = rows.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("long").alias("turn"), F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        text.alias("text"), F.unhex(F.sha2(text, 256)).alias("digest"))
    own = settle(own.withColumn("uid", F.monotonically_increasing_id()), "turns")
    order = settle(_ordered(own), "turn-faults")
    head = F.min(F.struct("pos", *PLACE)).alias("head")
    cells = F.sort_array(F.collect_list(F.struct("pos", "uid", "code"))).alias("cells")  # at most 2 ** BLOCK_BITS
    cut = order.groupBy("conv", F.shiftright("pos", BLOCK_BITS).alias("block")).agg(head, cells)
    cut = cut.select("conv", "block", "head", F.col("cells.uid").alias("uids"), F.col("cells.code").alias("codes"))
    blocks = with_rank(cut.withColumn("_all", F.lit(0)), "_all", [F.col("conv").asc_nulls_first(), F.col("block")], "r").drop("_all")
    blocks = settle(blocks, "turn-blocks")

    many = blocks.groupBy("conv").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    longest = many.agg(F.max("n")).first()[0] or 1
    if longest > 1:
        several = blocks.join(many.select(F.col("conv").alias("_conv")), F.col("conv").eqNullSafe(F.col("_conv")), "left_semi")
        sums = map_batches(several.select("r", "codes"), _transfers, "r int, m array<long>")
        sums = settle(several.select("conv", "r").join(sums, "r").select("conv", "r", F.col("m").alias("v")), "turn-costs")
        total = _doubled(sums, longest, 1, _product, "turn-costs")
        to_go = F.array(*[F.least(*[F.col("v")[4 * q + k] + int(END[k]) for k in range(4)]) for q in range(4)])
        blocks = _neighbour(blocks, total, 1, to_go, "after")
        blocks = _neighbour(blocks, blocks.select("conv", "r", F.get("codes", F.lit(0)).alias("c")), 1, F.col("c"), "next_code")
    else:
        blocks = blocks.withColumn("after", F.lit(None).cast("array<long>")).withColumn("next_code", F.lit(None).cast("int"))
    blocks = blocks.withColumn("last", F.col("next_code").isNull())
    end = F.array(*[F.lit(int(x)) for x in END]).cast("array<long>")
    ways = map_batches(blocks.select("r", "codes", F.coalesce("after", end).alias("after")), _paths, "r int, before array<long>, audits array<string>, exits array<long>")
    blocks = settle(blocks.join(ways, "r"), "turn-paths")
    if longest > 1:
        several = blocks.join(many.select(F.col("conv").alias("_conv")), F.col("conv").eqNullSafe(F.col("_conv")), "left_semi")
        states = _doubled(several.select("conv", "r", F.col("exits").alias("v")), longest, -1, _then, "turn-states")
        blocks = _neighbour(blocks, states, -1, F.get("v", F.lit(0)), "state")
    else:
        blocks = blocks.withColumn("state", F.lit(None).cast("long"))
    blocks = blocks.withColumn("first", F.col("state").isNull()).withColumn("entry", F.coalesce("state", F.lit(0)).cast("int"))
    out_state = F.get("exits", F.col("entry")).cast("int")
    tail = F.when(F.col("last"), F.get(F.array(*map(F.lit, TAIL)), out_state)).otherwise(F.lit(""))
    pair = lambda a, b: ((F.shiftright(a, 2) == USER) & (F.shiftright(b, 2) == ASSISTANT)) | (F.shiftright(a, 2).isin(SYSTEM, ASSISTANT) & (F.shiftright(b, 2) == USER))
    ahead = F.expr("slice(codes, 2, size(codes))")
    behind = F.expr("slice(codes, 1, size(codes) - 1)")
    inside = F.size(F.filter(F.zip_with(behind, ahead, pair), lambda ok: ~ok))
    across = F.when(~F.col("last") & ~pair(F.element_at("codes", -1), F.col("next_code")), 1).otherwise(0)
    found = blocks.select(
        "conv", "r", "head", "uids", "codes", "entry", F.concat(F.get("audits", F.col("entry")), tail).alias("audit"),
        (inside + across).cast("long").alias("illegal"), F.when(F.col("first"), F.col("before")[0]).otherwise(F.lit(0)).cast("long").alias("cost"))
    return Repair(own, order, settle(found, "turn-edits"))
