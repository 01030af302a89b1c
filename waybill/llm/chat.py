"""Least-cost repair of conversations whose turns break the role order, and their rendering.

A legal conversation is an optional system turn, then user and assistant turns in alternation, an
assistant turn last. Each turn may keep its role or be relabelled; equal neighbours are merged into
one turn; an empty turn may be inserted where one role is missing. A dynamic programme over the
automaton of the last role finds the cheapest repair.

A conversation is never one task's work. It is cut into blocks by turn number; a block becomes the
matrix of its costs between entry and exit role; matrices are multiplied level by level, the best
roles at the block borders are handed down again, and each block is repaired on its own.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waybill.llm import shared

START, SYSTEM, USER, ASSISTANT = range(4)
ROLES = ["", "system", "user", "assistant"]
CODES = "?sua"
BLOCK_TURNS = 512
FAN = 512
#: The turn to insert between two roles; the pairs that need none are legal as they are.
LEGAL = {(START, SYSTEM), (START, USER), (SYSTEM, USER), (USER, ASSISTANT), (ASSISTANT, USER)}
MISSING = {(START, ASSISTANT): USER, (SYSTEM, ASSISTANT): USER}


@dataclass(frozen=True)
class Costs:
    merge: float = 1.0
    relabel: float = 2.0
    insert: float = 3.0


def moves(costs: Costs) -> np.ndarray:
    """Cost of the next turn's role after the last one's, inserted turns included."""
    out = np.full((4, 4), np.inf)
    for pair in LEGAL:
        out[pair] = 0.0
    for pair in MISSING:
        out[pair] = costs.insert
    for role in (SYSTEM, USER, ASSISTANT):
        out[role, role] = costs.merge
    return out


def ending(costs: Costs) -> np.ndarray:
    """Cost of ending after each role: turns that are missing at the end are inserted."""
    return np.array([0.0, 2 * costs.insert, costs.insert, 0.0])


def labels(code: str, costs: Costs) -> np.ndarray:
    """Cost of giving a turn each role; an unknown role costs a relabelling whatever it becomes."""
    out = np.full(4, costs.relabel)
    out[START] = np.inf
    if code in CODES[1:]:
        out[CODES.index(code)] = 0.0
    return out


@lru_cache(1 << 14)
def block_matrix(codes: str, costs: Costs) -> np.ndarray:
    """Least cost of a run of turns between every entry and exit role."""
    total = np.where(np.eye(4, dtype=bool), 0.0, np.inf)
    step = moves(costs)
    for code in codes:
        total = (total[:, :, None] + step[None]).min(axis=1) + labels(code, costs)
    return total


def product(matrices: list[np.ndarray]) -> np.ndarray:
    total = matrices[0]
    for m in matrices[1:]:
        total = (total[:, :, None] + m[None]).min(axis=1)
    return total


def borders(matrices: list[np.ndarray], entry: int, leave: int) -> list[int]:
    """Roles at the borders of consecutive blocks on a cheapest way; of equal ways the smaller role last."""
    costs = [np.where(np.arange(4) == entry, 0.0, np.inf)]
    for m in matrices:
        costs.append((costs[-1][:, None] + m).min(axis=0))
    roles = [leave]
    for m, before in zip(reversed(matrices), reversed(costs[:-1])):
        roles.append(int((before + m[:, roles[-1]]).argmin()))
    return roles[::-1]


@lru_cache(1 << 14)
def block_roles(codes: str, entry: int, leave: int, costs: Costs) -> list[int]:
    """The role before the block and that of each of its turns on a cheapest way."""
    step = moves(costs)
    return borders([step + labels(code, costs) for code in codes], entry, leave)


def _matrix(flat) -> np.ndarray:
    return np.asarray(flat, float).reshape(4, 4)


def repaired(turns: DataFrame, costs: Costs = Costs(), block_turns: int = BLOCK_TURNS) -> DataFrame:
    """Every turn with its repaired role and its part of the rendered conversation.

    Returns ``conv_id``, ``turn``, ``role`` (as given), ``text``, ``new_role``, ``action`` (keep, relabel,
    merge, relabel and merge), ``inserted`` (role of an empty turn put before, else NULL) and ``rendered``;
    the parts of a conversation, in order of turn, make up its rendering, ``<|role|>`` and ``<|end|>``
    around each turn, merged texts parted by a blank line.

    NULL conv_id is one conversation, a NULL turn comes first, a NULL text is empty, a NULL or unknown
    role is given one. Rows of one turn number (repeated rows too) follow in order of role and text and
    share a block, as do all rows without turn number. An empty table gives no rows; other columns are
    dropped. Of equally cheap repairs the one is taken whose earlier roles come first in the order
    system, user, assistant.
    """
    code = F.create_map(*[F.lit(x) for r, c in zip(ROLES[1:], CODES[1:]) for x in (r, c)])
    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.col("role").alias("role"),
        F.col("text").alias("text"),
        F.coalesce(F.floor(F.col("turn") / block_turns).cast("long"), F.lit(-(1 << 62))).alias("_block"),
    )
    order = Window.partitionBy("conv_id", "_block").orderBy("turn", "role", "text")
    placed = shared.kept(rows.withColumn("_at", F.row_number().over(order)).withColumn("_code", F.coalesce(code[F.col("role")], F.lit("?"))))
    leaves = placed.groupBy("conv_id", "_block").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("_at", "_code"))), lambda x: x["_code"]), "").alias("_codes")
    )

    @F.pandas_udf("array<double>")
    def matrix(codes: pd.Series) -> pd.Series:
        return codes.map(lambda c: block_matrix(c, costs).ravel())

    @F.pandas_udf("array<double>")
    def multiplied(parts: pd.Series) -> pd.Series:
        return parts.map(lambda p: product([_matrix(x) for x in p]).ravel())

    @F.pandas_udf("array<int>")
    def split(parts: pd.Series, entry: pd.Series, leave: pd.Series) -> pd.Series:
        return pd.Series([borders([_matrix(x) for x in p], int(a), int(b)) for p, a, b in zip(parts, entry, leave)], dtype=object)

    @F.pandas_udf("int")
    def best_end(flat: pd.Series) -> pd.Series:
        return flat.map(lambda m: int((_matrix(m)[START] + ending(costs)).argmin()))

    @F.pandas_udf("array<int>")
    def roles(codes: pd.Series, entry: pd.Series, leave: pd.Series) -> pd.Series:
        return pd.Series([block_roles(c, int(a), int(b), costs) for c, a, b in zip(codes, entry, leave)], dtype=object)

    wide = F.floor(F.col("_id") / FAN).alias("_up")
    # The blocks of a conversation are numbered from 0 without gaps, that of NULL turns first, so levels end.
    number = (F.row_number().over(Window.partitionBy("conv_id").orderBy("_block")) - 1).cast("long").alias("_id")
    first = leaves.select("conv_id", "_block", number, "_codes", matrix("_codes").alias("_m"))
    levels = [shared.kept(first.select("*", wide))]
    while levels[-1].select("conv_id", "_up").distinct().groupBy("conv_id").count().where("count > 1").limit(1).count():
        up = _gathered(levels[-1]).select("conv_id", F.col("_up").alias("_id"), multiplied("_parts").alias("_m"))
        levels.append(shared.kept(up.select("*", wide)))
    top = _gathered(levels[-1])
    down = top.select(
        "conv_id", "_members", "_parts", F.lit(START).alias("_entry"), best_end(multiplied("_parts")).alias("_leave"), F.lit(True).alias("_last")
    )
    for level in reversed(levels):
        ways = down.withColumn("_way", split("_parts", "_entry", "_leave"))
        members = ways.select("conv_id", "_last", "_way", F.size("_members").alias("_size"), F.posexplode("_members").alias("_k", "_id")).select(
            "conv_id",
            "_id",
            F.col("_way")[F.col("_k")].alias("_entry"),
            F.col("_way")[F.col("_k") + 1].alias("_leave"),
            (F.col("_last") & (F.col("_k") == F.col("_size") - 1)).alias("_last"),
        )
        if level is levels[0]:
            break
        below = levels[levels.index(level) - 1]
        same = [F.col("g.conv_id").eqNullSafe(F.col("m.conv_id")), F.col("g._up") == F.col("m._id")]
        down = _gathered(below).alias("g").join(members.alias("m"), same).select("g.conv_id", "_members", "_parts", "_entry", "_leave", "_last")
    same = [F.col("l.conv_id").eqNullSafe(F.col("m.conv_id")), F.col("l._id") == F.col("m._id")]
    solved = levels[0].alias("l").join(members.alias("m"), same).select(
        F.col("l.conv_id").alias("_conv"), F.col("l._block").alias("_b"), "_last", roles("_codes", "_entry", "_leave").alias("_roles")
    )
    each = solved.select("_conv", "_b", "_last", F.size("_roles").alias("_size"), "_roles", F.explode(F.sequence(F.lit(1), F.size("_roles") - 1)).alias("_k")).select(
        "_conv",
        "_b",
        "_k",
        F.col("_roles")[F.col("_k") - 1].alias("_before"),
        F.col("_roles")[F.col("_k")].alias("_now"),
        (F.col("_last") & (F.col("_k") == F.col("_size") - 1)).alias("_end"),
    )
    same = [F.col("conv_id").eqNullSafe(F.col("_conv")), F.col("_block") == F.col("_b"), F.col("_at") == F.col("_k")]
    return _rendered(placed.join(each, same))


def _gathered(level: DataFrame) -> DataFrame:
    """The members of each wider block in order, with their matrices; at most ``FAN`` of them."""
    parts = F.array_sort(F.collect_list(F.struct("_id", "_m")))
    return level.groupBy("conv_id", "_up").agg(parts.alias("_s")).select(
        "conv_id", "_up", F.transform("_s", lambda x: x["_id"]).alias("_members"), F.transform("_s", lambda x: x["_m"]).alias("_parts")
    )


def _rendered(rows: DataFrame) -> DataFrame:
    name = F.array(*[F.lit(r) for r in ROLES])
    before, now = F.col("_before"), F.col("_now")
    merged = before == now
    given = F.coalesce(F.col("role"), F.lit(""))
    relabelled = given != name[now]
    blank = lambda role: f"<|{role}|>\n<|end|>\n"
    missing = F.lit(None)
    for (a, b), role in MISSING.items():
        missing = F.when((before == a) & (now == b), ROLES[role]).otherwise(missing)
    opening = F.concat(
        F.when(before != START, "<|end|>\n").otherwise(""),
        F.when(missing.isNotNull(), F.concat(F.lit("<|"), missing, F.lit("|>\n<|end|>\n"))).otherwise(""),
        F.lit("<|"),
        name[now],
        F.lit("|>\n"),
    )
    closing = F.concat(
        F.lit("<|end|>\n"),
        F.when(now == SYSTEM, blank("user") + blank("assistant")).when(now == USER, blank("assistant")).otherwise(""),
    )
    return rows.select(
        "conv_id",
        "turn",
        "role",
        "text",
        name[now].alias("new_role"),
        F.when(merged & relabelled, "relabel and merge").when(merged, "merge").when(relabelled, "relabel").otherwise("keep").alias("action"),
        missing.cast("string").alias("inserted"),
        F.concat(
            F.when(merged, "\n\n").otherwise(opening), F.coalesce("text", F.lit("")), F.when(F.col("_end"), closing).otherwise("")
        ).alias("rendered"),
    )
