"""Operator 11: repair of conversations by Knuth's lightest-derivation agenda.

A conversation's rows are read from left to right by a small automaton of role initials that
accepts ``(s?(ua)+)?``. A deduction item says that the rows up to ``i`` can be edited so that the
automaton gets from state ``p`` to state ``q``; its weight is (cost, audit), the edits' initials.
Edits extend an item by a row or by an inserted turn; two items of neighbouring pieces of a
conversation combine to one of both. Both rules are superior functions: the weight of what they
give is no less than any they are given and grows with each. So items are popped from an agenda
by weight, each is final when it is popped first, and the search ends when the goal is popped.
(Two audits of one item and one cost are never prefixes of each other: they have the same number
of edits of rows, and the inserts of the longer one would cost more. So the order of audits
stays when both are extended, which is what makes the weights monotone.)

No conversation meets one task whole. Rows get a gapless position by conversation and turn
from range partitions; blocks of ``BLOCK`` positions are solved each by itself. A conversation
inside a block is done there; of one that crosses blocks each block gives the items between all
states, and neighbouring ones are combined ``FAN`` at a time, level by level. Duplicates are found by
a grouping, so nothing remembers texts. Only the repaired text's hash must see the rows of
a conversation in order: they stream through a task in sorted batches and are never held together.

Defined results: null roles, texts, turns and (in the damage's key) conv_ids count as one space, but a
null turn is ordered first and is no number for gaps, and a null conv_id stays null: its rows are one
conversation. Rows of one turn are ordered by role, then text; a repeated row is a row; a copy follows its
original. A role whose first character is not s, u or a, or that is empty, cannot be kept. An empty table
gives no rows. Very long texts are streamed. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Iterator
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillcast.llm.common import table
from tillcast.session import stage

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
BLOCK, FAN = 2048, 32
BLANK = r"[^\x20\x09-\x0D]"
#: States: nothing yet, after s, after u, after a. The next state by initial.
STEPS = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
STATES, FINAL = range(4), (0, 3)
ROLES = {"u": "user", "a": "assistant"}

Weight = tuple[int, str]


def lightest(axioms: list[tuple], rules, goals: int, is_goal) -> dict:
    """The least weight of the first ``goals`` goal items. ``axioms``: (weight, item);
    ``rules(weight, item)`` yields the (weight, item) that a final item leads to."""
    agenda, final, found = list(axioms), set(), {}
    heapq.heapify(agenda)
    while agenda and len(found) < goals:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final.add(item)
        if is_goal(item):
            found[item] = weight
        for step in rules(weight, item):
            if step[1] not in final:
                heapq.heappush(agenda, step)
    return found


def edits(code: str) -> Iterator[tuple[int, str, str | None]]:
    """(cost, letter, initial) of the edits of a row; no initial if it is deleted. ``code`` is
    the row's initial, in upper case if truncated, or - if it must be deleted."""
    yield DELETE, "D", None
    if code != "-":
        extra = TRUNCATED if code.isupper() or code == "!" else 0
        yield REROLE + extra, "R", "u"
        yield REROLE + extra, "R", "a"
        if code.lower() in "sua":
            yield KEEP + extra, "K", code.lower()


@lru_cache(maxsize=4096)
def row_items(codes: str, start: int, whole: bool) -> dict[int, Weight]:
    """The lightest derivation over all rows of ``codes`` from state ``start`` to each state; of a
    ``whole`` conversation, only the lightest to an accepting state."""
    moves = {c: list(edits(c)) for c in set(codes)}

    def rules(weight, item):
        cost, audit = weight
        i, state = item
        for initial in ROLES:
            if initial in STEPS[state]:
                yield (cost + INSERT, audit + "I"), (i, STEPS[state][initial])
        if i < len(codes):
            for more, letter, initial in moves[codes[i]]:
                if initial is None or initial in STEPS[state]:
                    yield (cost + more, audit + letter), (i + 1, state if initial is None else STEPS[state][initial])

    ends = FINAL if whole else STATES
    found = lightest([((0, ""), (0, start))], rules, 1 if whole else len(STATES), lambda item: item[0] == len(codes) and item[1] in ends)
    return {q: w for (_, q), w in found.items()}


def joined_items(pieces: list[dict[tuple[int, int], Weight]], start: int) -> dict[int, Weight]:
    """The same over neighbouring pieces, from their items {(p, q): weight}."""
    def rules(weight, item):
        j, state = item
        if j < len(pieces):
            for (p, q), (cost, audit) in pieces[j].items():
                if p == state:
                    yield (weight[0] + cost, weight[1] + audit), (j + 1, q)

    return {q: w for (_, q), w in lightest([((0, ""), (0, start))], rules, len(STATES), lambda item: item[0] == len(pieces)).items()}


def outputs(audit: Iterator[str]) -> Iterator[tuple[str, str]]:
    """(edit, initial to give) of an audit's letters; K and D give none. A kept row's initial
    must be sent back."""
    state = 0
    for letter in audit:
        initial = "" if letter in "KD" else "a" if state == 2 else "u"
        sent = yield letter, initial
        if letter == "K":
            initial = sent
        if initial:
            state = STEPS[state][initial]


def conversation() -> Column:
    return F.coalesce(F.col("conv_id").cast("string"), F.lit(""))


def damaged(rows: DataFrame) -> DataFrame:
    """conv (the conv_id as text, '' for null), turn, role and text after the damage, and uid and
    copy, which tell equal rows apart."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    rows = rows.select(conversation().alias("conv"), "turn", role.alias("role"), text.alias("text"), (F.crc32(key.cast("binary")) % 20).alias("damage"))
    rows = rows.filter("damage <> 0")
    copies = F.explode(F.sequence(F.lit(0), (F.col("damage") == 3).cast("int")))
    hit = F.when(F.col("damage") == 1, "").when(F.col("damage") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    rows = rows.select("conv", "turn", F.when(F.col("damage") == 4, "user").otherwise(F.col("role")).alias("role"), hit.alias("text"), "damage")
    return rows.withColumn("uid", F.monotonically_increasing_id()).select("*", copies.alias("copy")).drop("damage")


def placed(rows: DataFrame) -> DataFrame:
    """Stored rows with ``pos``, gapless from 0 by conversation, turn, role and text: range
    partitions sorted by themselves, and the sizes of those before."""
    order = ["conv", "turn", "role", "text", "uid", "copy"]
    inside = rows.repartitionByRange(*order).sortWithinPartitions(*order).drop("uid", "copy")
    # The id counts a partition's rows in order; the partition is in its upper bits.
    parts = stage(inside.withColumn("at", F.monotonically_increasing_id()), "turns")
    part = F.shiftright("at", 33)
    sizes = parts.groupBy(part.alias("part")).count()
    sizes = sizes.select("part", F.col("count").alias("n")).collect()  # one row per partition
    before, total = {}, 0
    for p, n in sorted(sizes):
        before[p], total = total, total + n
    starts = F.lit([before.get(p, 0) for p in range(max(before, default=0) + 1)]).cast("array<bigint>")
    return parts.select("conv", "turn", "role", "text", (F.col("at").bitwiseAND((1 << 33) - 1) + F.get(starts, part.cast("int"))).alias("pos"))


def judged(rows: DataFrame) -> DataFrame:
    """pos, conv, turn and code (see ``edits``; blank, duplicate and truncated are told by
    fault) of ``placed`` rows. Stored, without texts."""
    last = F.regexp_extract("text", r"(" + BLANK + r")[\x20\x09-\x0D]*\z", 1)
    key = F.sha2(F.concat(F.hex(F.col("role").cast("binary")), F.lit(":"), F.col("text")).cast("binary"), 256)
    slim = stage(rows.select("pos", "conv", "turn", F.substring("role", 1, 1).alias("initial"), F.when(last != "", key).alias("key"),
                             (~last.isin(".", "!", "?")).alias("cut")), "slim")
    # Only rows that come twice are stored here, and stored so that a hot one is a skewed join.
    twice = slim.filter("key is not null").groupBy("conv", "key").agg(F.min("pos").alias("first"), F.count("*").alias("n")).filter("n > 1")
    both = slim.join(stage(twice.drop("n"), "twice"), ["conv", "key"], "left")
    fault = (F.when(F.col("key").isNull(), "blank").when(F.col("pos") > F.col("first"), "duplicate").when(F.col("cut"), "truncated"))
    legal = F.col("initial").isin("s", "u", "a")
    code = (F.when(F.col("fault").isin("blank", "duplicate"), "-").when(F.col("fault") == "truncated", F.when(legal, F.upper("initial")).otherwise("!"))
            .when(legal, F.col("initial")).otherwise("?"))
    return stage(both.withColumn("fault", fault).select("pos", "conv", "turn", "initial", "fault", code.alias("code")), "judged_turns")


PIECE = "conv string, whole boolean, piece long, first string, last string, illegal long, p int, q int, cost long, audit string"
COLUMNS = [c.split()[0] for c in PIECE.split(", ")]
FOLLOWS = ("su", "ua", "au")


def broken(initials: list[str]) -> int:
    return sum(a + b not in FOLLOWS for a, b in zip(initials, initials[1:], strict=False))


def solve_block(block: pd.DataFrame) -> pd.DataFrame:
    """The pieces of conversations in one block of positions."""
    block, out = block.sort_values("pos", ignore_index=True), []
    base, top = int(block["pos"].iloc[0]), int(block["pos"].iloc[-1])
    for conv, rows in block.groupby("conv", sort=False):
        codes, initials = "".join(rows["code"]), list(rows["initial"])
        whole = rows["pos"].iloc[0] > base and rows["pos"].iloc[-1] < top  # surely no row in another block
        head = (conv, whole, int(rows["block"].iloc[0]), initials[0], initials[-1], broken(initials))
        if whole:
            out += [(*head, 0, q, *w) for q, w in row_items(codes, 0, True).items()]
        else:
            out += [(*head, p, q, *w) for p in STATES for q, w in row_items(codes, p, False).items()]
    return pd.DataFrame(out, columns=COLUMNS)


def combine(rows: pd.DataFrame) -> pd.DataFrame:
    """Neighbouring pieces of one conversation as one."""
    pieces, illegal, firsts, lasts = [], 0, [], []
    for _, piece in rows.groupby("piece"):
        pieces.append({(r.p, r.q): (r.cost, r.audit) for r in piece.itertuples()})
        illegal += int(piece["illegal"].iloc[0])
        firsts.append(piece["first"].iloc[0])
        lasts.append(piece["last"].iloc[0])
    illegal += sum(broken([a, b]) for a, b in zip(lasts, firsts[1:], strict=False))
    head = (rows["conv"].iloc[0], False, int(rows["group"].iloc[0]), firsts[0], lasts[-1], illegal)
    out = [(*head, p, q, *w) for p in STATES for q, w in joined_items(pieces, p).items()]
    return pd.DataFrame(out, columns=COLUMNS)


def derivations(judged_rows: DataFrame) -> DataFrame:
    """conv, illegal, cost and audit of every conversation that has rows."""
    blocks = judged_rows.select("pos", "conv", "initial", "code").withColumn("block", F.floor(F.col("pos") / BLOCK))
    pieces = stage(blocks.groupBy("block").applyInPandas(solve_block, PIECE), "pieces")
    done, open_ = [pieces.filter("whole")], pieces.filter("not whole")
    while not open_.isEmpty():
        # A conversation of one piece is done; of the others, FAN neighbours become one.
        ends = open_.groupBy("conv").agg(F.min("piece").alias("low"), F.max("piece").alias("high"))
        both = open_.join(stage(ends, "ends"), "conv")
        goal = both.filter((F.col("low") == F.col("high")) & (F.col("p") == 0) & F.col("q").isin(*FINAL))
        least = goal.groupBy("conv").agg(F.min_by(F.struct("illegal", "cost", "audit"), F.struct("cost", "audit")).alias("b"))
        done.append(stage(least.select("conv", "b.*"), "solved"))
        group = both.filter("low < high").withColumn("group", F.floor((F.col("piece") - F.col("low")) / FAN)).drop("low", "high")
        open_ = stage(group.groupBy("conv", "group").applyInPandas(combine, PIECE), "combined")
    out = done[0].select("conv", "illegal", "cost", "audit")
    for more in done[1:]:
        out = out.unionByName(more.select("conv", "illegal", "cost", "audit"))
    return stage(out, "derivations")


def repaired_hashes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The hash of each conversation's repaired text. A conversation comes as its audit (pos -1) and
    then its rows in order."""
    state = None  # conv, hash, walk over the audit, its letter now, whether a line was written

    def write(line: str) -> None:
        state["hash"].update((("\n" if state["lines"] else "") + line).encode())
        state["lines"] = True

    def advance(sent=None) -> None:
        """To the next letter that reads a row; inserts are written on the way."""
        try:
            state["now"] = state["walk"].send(sent)
            while state["now"][0] == "I":
                write(f"{ROLES[state['now'][1]]}:")
                state["now"] = next(state["walk"])
        except StopIteration:
            state["now"] = None

    for batch in batches:
        out = []
        for conv, pos, role, text in zip(batch["conv"], batch["pos"], batch["role"], batch["text"], strict=True):
            if pos < 0:
                if state:
                    out.append((state["conv"], state["hash"].hexdigest()))
                state = {"conv": conv, "hash": hashlib.sha256(), "walk": outputs(iter(text)), "lines": False}
                advance()
                continue
            letter, initial = state["now"]
            if letter != "D":
                write(f"{role if letter == 'K' else ROLES[initial]}:{text}")
            advance(role[:1])
        yield pd.DataFrame(out, columns=["conv", "repaired_sha256"])
    if state:
        yield pd.DataFrame([(state["conv"], state["hash"].hexdigest())], columns=["conv", "repaired_sha256"])


def repair(conversations: DataFrame) -> DataFrame:
    """Every conv_id of ``conversations`` with its damage's faults and its lightest repair."""
    turns = placed(damaged(conversations))
    checked = judged(turns)
    solved = derivations(checked)
    said = lambda f: F.count(F.when(F.col("fault") == f, 1)).alias(f)
    faults = checked.groupBy("conv").agg(*map(said, ("blank", "duplicate", "truncated")), F.min("turn").alias("low"), F.max("turn").alias("high"))
    spread = checked.select("conv", "turn").filter("turn is not null").distinct().groupBy("conv").agg(F.count("*").alias("n"))
    header = solved.select("conv", F.lit(-1).cast("long").alias("pos"), F.lit("").alias("role"), F.col("audit").alias("text"))
    lines = header.unionByName(turns.select("conv", "pos", "role", "text")).repartition("conv").sortWithinPartitions("conv", "pos")
    hashes = lines.mapInPandas(repaired_hashes, "conv string, repaired_sha256 string")
    out = conversations.select("conv_id").distinct().withColumn("conv", conversation())
    for more in (faults, spread, solved, hashes):
        out = out.join(more, "conv", "left")
    zero = lambda c, name="": F.coalesce(c, F.lit(0)).cast("long").alias(name or c)
    return out.select("conv_id", zero(F.col("high") - F.col("low") + 1 - F.col("n"), "gaps"), *map(zero, ("blank", "duplicate", "truncated", "illegal", "cost")),
                      F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(table(spark, sf_dir, "conversations"))
