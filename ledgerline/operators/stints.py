"""From an ordered event log to stints: intervals with an unchanged line-up.

The log of a match is a small state machine: periods start and end, substitutions wait
until the next play and then close the current stint and open another. Every piece of
that state is a running value along ``(seq, tie)``:

* ``active``   the latest period marker before the row is a start;
* ``pending``  the latest row before it that can settle substitutions is one itself;
* ``opened``   the row opens a stint: a period start, or a play that finds some pending;
* ``sid``      opens so far less one, hence the number of the latest stint;
* ``closes``   the stint the row closes, if any;
* ``target``   the stint a play counts for: the current one, or after the buzzer the last
  one closed.

Stints, line-ups and statistics are then plain aggregations and equi-joins on the match
and the stint number, so they spread over the cluster even inside one match.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerline.functions.calendar import clock_seconds
from ledgerline.operators.chunks import (
    CHUNK,
    DEFAULT_CHUNK_ROWS,
    next_in_key,
    split_hot_keys,
)
from ledgerline.operators.lookups import lookup
from ledgerline.rules import SCORING, STATS, stat_increment
from ledgerline.session import cut_lineage

ORDER = ("seq", "tie")
LOG_COLUMNS = ("match_id", "seq", "tie", "kind", "code", "clk", "team_id", "player_id")
# Stint numbers are expanded in blocks of this width, so that no row holds a long array.
BLOCK = 4096


# What a piece of a match hands on: whether a period runs, substitutions wait and a stint is open,
# how many stints were opened, periods started, ended and buzzers heard, the last stint closed.
_START = {
    "c_marker": "false", "c_pending": "false", "c_life": "false", "c_opens": "0L", "c_nperiod": "0L", "c_epoch": "0L",
    "c_buzzers": "0L", "c_closed": "CAST(null AS bigint)",
}


def _piece_states(rows: DataFrame) -> DataFrame:
    """``(match_id, chunk)`` and the state at the start of each piece, in one pass over the rows.

    What a piece does depends on three flags of the state before it, and only until a row of its
    own settles them. So it is summarised for every value of the flags (m: a period runs, p:
    substitutions wait, l: a stint is open) at once; the summaries are transitions, which are
    composed along the pieces of a match, of which there is one per ``chunk_rows`` rows.
    """
    window = Window.partitionBy("match_id", CHUNK).orderBy(*ORDER)
    before, upto = window.rowsBetween(Window.unboundedPreceding, -1), window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kind, flags = F.col("kind"), (False, True)
    is_start, is_end, is_play = kind == "START", kind == "END", kind == "PLAY"
    last = lambda name: F.last(name, ignorenulls=True).over(before)
    inherited = lambda name, flag: F.coalesce(F.col(name), F.lit(flag))

    rows = rows.select("match_id", CHUNK, *ORDER, "kind", F.when(is_start, True).when(is_end, False).alias("marker"))
    rows = rows.withColumn("was_marker", last("marker"))
    settles = {
        f"settles{m:d}": F.when(kind.isin("IN", "OUT"), True).when(is_start | is_play | (is_end & inherited("was_marker", m)), False) for m in flags
    }
    rows = rows.withColumns(settles).withColumns({f"was_{name}": last(name) for name in settles})
    pairs = [(m, p) for m in flags for p in flags]
    opened = {f"opened{m:d}{p:d}": is_start | (is_play & inherited(f"was_settles{m:d}", p)) for m, p in pairs}
    rows = rows.withColumns(opened)
    rows = rows.withColumns({f"life{m:d}{p:d}": F.when(F.col(f"opened{m:d}{p:d}"), True).when(is_end, False) for m, p in pairs})
    rows = rows.withColumns({
        **{f"was_life{m:d}{p:d}": last(f"life{m:d}{p:d}") for m, p in pairs},
        **{f"opens{m:d}{p:d}": F.sum(F.col(f"opened{m:d}{p:d}").cast("bigint")).over(upto) for m, p in pairs},
    })

    def closes(m: bool, p: bool, held: bool) -> Column:
        sid = F.col(f"opens{m:d}{p:d}") - 1
        ended = is_end & inherited("was_marker", m)
        return F.when(ended, sid).when(is_play & F.col(f"opened{m:d}{p:d}") & inherited(f"was_life{m:d}{p:d}", held), sid - 1)

    latest = lambda name: F.max_by(F.col(name), F.when(F.col(name).isNotNull(), F.struct(*ORDER)))
    times = lambda flag: F.sum(flag.cast("bigint"))
    pieces = rows.groupBy("match_id", CHUNK).agg(
        latest("marker").alias("marker"),
        F.array(*[latest(f"settles{m:d}") for m in flags]).alias("settles"),
        F.array(*[latest(f"life{m:d}{p:d}") for m, p in pairs]).alias("life"),
        F.array(*[times(F.col(f"opened{m:d}{p:d}")) for m, p in pairs]).alias("opens"),
        F.array(*[times(is_end & inherited("was_marker", m)) for m in flags]).alias("buzzers"),
        F.array(*[F.max(closes(m, p, held)) for m, p in pairs for held in flags]).alias("closes"),
        times(is_start).alias("nperiod"), times(is_end).alias("epoch"),
    )
    in_order = F.sort_array(F.collect_list(F.struct(CHUNK, *[c for c in pieces.columns if c not in ("match_id", CHUNK)])))

    def compose(done: Column, piece: Column) -> Column:
        now = done["now"]
        m = now["c_marker"].cast("int")
        mp = 2 * m + now["c_pending"].cast("int")
        mpl = 2 * mp + now["c_life"].cast("int")
        then = {
            "c_marker": F.coalesce(piece["marker"], now["c_marker"]),
            "c_pending": F.coalesce(F.get(piece["settles"], m), now["c_pending"]),
            "c_life": F.coalesce(F.get(piece["life"], mp), now["c_life"]),
            "c_opens": now["c_opens"] + F.get(piece["opens"], mp),
            "c_nperiod": now["c_nperiod"] + piece["nperiod"],
            "c_epoch": now["c_epoch"] + piece["epoch"],
            "c_buzzers": now["c_buzzers"] + F.get(piece["buzzers"], m),
            "c_closed": F.greatest(now["c_closed"], now["c_opens"] + F.get(piece["closes"], mpl)),
        }
        at_start = F.struct(piece[CHUNK].alias(CHUNK), *[now[name].alias(name) for name in _START])
        return F.struct(
            F.struct(*[value.alias(name) for name, value in then.items()]).alias("now"),
            F.concat(done["starts"], F.array(at_start)).alias("starts"),
        )

    start = F.struct(*[F.expr(value).alias(name) for name, value in _START.items()])
    kinds = ",".join(f"{name}:{'boolean' if value == 'false' else 'bigint'}" for name, value in _START.items())
    nothing = F.array().cast(f"array<struct<{CHUNK}:int,{kinds}>>")
    composed = F.aggregate("pieces", F.struct(start.alias("now"), nothing.alias("starts")), compose, lambda done: done["starts"])
    states = pieces.groupBy("match_id").agg(in_order.alias("pieces")).select("match_id", F.explode(composed).alias("state"))
    # One row per piece, written down so that the rows are not summarised again.
    return cut_lineage(states.select("match_id", "state.*"))


def _annotate(rows: DataFrame, chunked: bool, extras: Sequence[str]) -> DataFrame:
    """Add the running state to every row; see the module text for the columns."""
    window = Window.partitionBy("match_id", CHUNK) if chunked else Window.partitionBy("match_id")
    window = window.orderBy(*ORDER)
    before = window.rowsBetween(Window.unboundedPreceding, -1)
    upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    kind = F.col("kind")
    is_start, is_end, is_play = kind == "START", kind == "END", kind == "PLAY"
    is_sub = kind.isin("IN", "OUT")

    def running_last(value: Column, carried: str) -> Column:
        inside = F.last(value, ignorenulls=True).over(before)
        return F.coalesce(inside, F.col(carried) if chunked else F.lit(None), F.lit(False))

    marker = F.when(is_start, True).when(is_end, False)
    if chunked:
        rows = rows.join(_piece_states(rows), ["match_id", CHUNK])
    rows = rows.withColumn("active", running_last(marker, "c_marker"))

    settles = F.when(is_sub, True).when(is_start | is_play | (is_end & F.col("active")), False)
    rows = rows.withColumn("opened", is_start | (is_play & running_last(settles, "c_pending")))
    rows = rows.withColumn("ended", is_end & F.col("active"))

    counted = {"opens": F.col("opened"), "nperiod": is_start, "epoch": is_end, "buzzers": F.col("ended")}
    life = F.when(F.col("opened"), True).when(is_end, False)
    rows = rows.select(
        "*",
        running_last(life, "c_life").alias("has_current"),
        *[
            (F.sum(flag.cast("bigint")).over(upto) + (F.col(f"c_{name}") if chunked else F.lit(0))).alias(name)
            for name, flag in counted.items()
        ],
    )
    sid = F.col("opens") - 1
    closes = F.when(F.col("ended"), sid).when(is_play & F.col("opened") & F.col("has_current"), sid - 1)
    rows = rows.withColumn("sid", sid).withColumn("closes", closes)

    closed = F.greatest(F.max("closes").over(upto), F.col("c_closed") if chunked else F.lit(None).cast("bigint"))
    rows = rows.withColumn("target", F.when(F.col("active"), F.col("sid")).otherwise(closed))
    side = ["home"] if "home" in rows.columns else []
    return rows.select(
        *LOG_COLUMNS, *side, *extras, "opened", "sid", "closes", "target", "nperiod", "epoch", "buzzers",
        F.col(CHUNK) if chunked else F.lit(-1).alias(CHUNK),
    )


@dataclass
class StintTables:
    """Tables derived from one annotated log.

    ``annotated`` feeds several branches; call ``keep`` before using more than one of them
    and ``release`` when they have been written.
    """

    annotated: DataFrame
    split: bool
    scoring: dict[str, dict[str, int]]
    # Columns of the match carried along: home_id and away_id, and those asked for.
    extras: tuple[str, ...] = ()
    match_columns: tuple[str, ...] = ()

    def keep(self) -> StintTables:
        self.annotated = self.annotated.persist(StorageLevel.MEMORY_AND_DISK)
        return self

    def release(self) -> None:
        self.annotated.unpersist()

    @property
    def used_stats(self) -> list[str]:
        return [s for s in STATS if any(s in adds for adds in self.scoring.values())]

    def _sums(self, prefix: str = "", condition: Column | None = None) -> list[Column]:
        """One sum per counter that some event can raise; the rest are constant zero."""
        used = self.used_stats
        columns = []
        for stat in used:
            value = stat_increment(F.col("code"), stat, self.scoring)
            if condition is not None:
                value = F.when(condition, value).otherwise(F.lit(0).cast("bigint"))
            columns.append(F.sum(value).alias(prefix + stat))
        return columns

    def _scored(self) -> DataFrame:
        scored = F.col("code").isin(*self.scoring)
        return self.annotated.filter((F.col("kind") == "PLAY") & scored & F.col("target").isNotNull())

    def _all_stints(self) -> DataFrame:
        """Every stint with its opening and closing clock, kept when it was closed."""
        opening = F.struct(
            F.col("sid").alias("stint_id"), F.col("nperiod"), F.col("clk").alias("start_clk"),
            F.lit(None).cast("string").alias("end_clk"), F.lit(False).alias("closed"), *self.match_columns,
        )
        closing = F.struct(
            F.col("closes").alias("stint_id"), F.lit(None).cast("bigint").alias("nperiod"),
            F.lit(None).cast("string").alias("start_clk"), F.col("clk").alias("end_clk"), F.lit(True).alias("closed"), *self.match_columns,
        )
        ends = self.annotated.filter(F.col("opened") | F.col("closes").isNotNull()).select(
            "match_id",
            F.explode(
                F.filter(
                    F.array(F.when(F.col("opened"), opening), F.when(F.col("closes").isNotNull(), closing)),
                    lambda e: e.isNotNull(),
                )
            ).alias("e"),
        )
        return (
            ends.select("match_id", "e.*")
            .groupBy("match_id", "stint_id")
            .agg(
                F.max("nperiod").alias("nperiod"),
                F.max("start_clk").alias("start_clk"),
                F.max("end_clk").alias("end_clk"),
                F.max("closed").alias("closed"),
                *[F.max(c).alias(c) for c in self.match_columns],
            )
            .filter("closed")
            .drop("closed")
        )

    def stints(self) -> DataFrame:
        """One row per closed stint."""
        return self._all_stints().select(
            "stint_id", "match_id", "nperiod", "start_clk", "end_clk",
            (clock_seconds(F.col("start_clk")) - clock_seconds(F.col("end_clk"))).alias("duration_sec"),
            *self.match_columns,
        )

    def _closed_ids(self) -> DataFrame:
        return self.annotated.filter(F.col("closes").isNotNull()).select(
            "match_id", F.col("closes").alias("stint_id")
        )

    def _intervals(self) -> DataFrame:
        """Per (match, side, player): from which stint to before which stint on court."""
        subs = self.annotated.filter(F.col("kind").isin("IN", "OUT"))
        # Substitutions that wait for the same open: the last one of a player counts. The
        # aggregation shrinks them before the join, whatever their number.
        last_action = subs.groupBy("match_id", (F.col("sid") + 1).alias("sid"), "buzzers", "home", "player_id").agg(
            F.max(F.struct(*ORDER, (F.col("kind") == "IN").alias("entering")))["entering"].alias("entering")
        )
        opens = self.annotated.filter("opened").select("match_id", "sid", "buzzers", "epoch", CHUNK, *self.extras)
        # A period end in between discards the waiting substitutions, hence ``buzzers``.
        applied = last_action.join(opens, ["match_id", "sid", "buzzers"]).drop("buzzers")
        keys = ["match_id", "epoch", "home", "player_id"]
        if self.split:
            spans = next_in_key(applied, keys, "sid", "sid", "until")
        else:
            spans = applied.withColumn("until", F.lead("sid").over(Window.partitionBy(*keys).orderBy("sid")))
        # Who never goes off stays until the epoch ends. Only these few rows need the lookup;
        # the others have no key and are spread.
        period = F.struct("match_id", "epoch")
        epoch_end = opens.groupBy("match_id", "epoch").agg((F.max("sid") + 1).alias("epoch_until"))
        stays = spans.filter("entering").withColumn("stays", F.when(F.col("until").isNull(), period))
        ended = lookup(
            stays, epoch_end.withColumn("period", period), "stays", "period", {"epoch_until": "epoch_until"}
        )
        return ended.select(
            "match_id", "home", "player_id", *self.extras, "sid", F.coalesce("until", "epoch_until").alias("until")
        )

    def lineups(self) -> DataFrame:
        """One row per closed stint and player on court, on either side."""
        spans = self._intervals()
        rest = [c for c in spans.columns if c not in ("sid", "until")]
        last = F.col("until") - 1
        blocks = spans.withColumn("block", F.explode(F.sequence(F.floor(F.col("sid") / BLOCK), F.floor(last / BLOCK))))
        on_court = blocks.select(
            *rest,
            F.explode(
                F.sequence(
                    F.greatest(F.col("sid"), F.col("block") * BLOCK),
                    F.least(last, F.col("block") * BLOCK + (BLOCK - 1)),
                )
            ).alias("stint_id"),
        )
        return on_court.join(self._closed_ids(), ["match_id", "stint_id"])

    def player_stints(self) -> DataFrame:
        """One row per closed stint and player on court, with every counter."""
        lineups = self.lineups()
        sums = (
            self._scored()
            .groupBy("match_id", F.col("target").alias("stint_id"), "player_id")
            .agg(*self._sums())
            .select(
                F.col("match_id").alias("s_match"), F.col("stint_id").alias("s_stint"),
                F.col("player_id").alias("s_player"), *self.used_stats,
            )
        )
        same = (
            (F.col("match_id") == F.col("s_match"))
            & (F.col("stint_id") == F.col("s_stint"))
            & F.col("player_id").eqNullSafe(F.col("s_player"))
        )
        joined = lineups.join(sums, same, "left")
        if "home_id" in lineups.columns:
            team = F.when(F.col("home"), F.col("home_id")).otherwise(F.col("away_id"))
        else:
            team = F.when(F.col("home"), F.lit("HOME")).otherwise(F.lit("AWAY"))
        return joined.select(
            "stint_id", "match_id", "player_id", team.alias("team_id"), *self._filled(), *self.match_columns,
        )

    def _filled(self, prefix: str = "") -> list[Column]:
        used = self.used_stats
        zero = F.lit(0).cast("bigint")
        return [
            (F.coalesce(F.col(prefix + s), zero) if s in used else zero).alias(prefix + s) for s in STATS
        ]

    def team_stints(self, with_lineups: bool = False) -> DataFrame:
        """One row per closed stint with the counters of both sides (``h_`` and ``a_``)."""
        sums = (
            self._scored()
            .groupBy("match_id", F.col("target").alias("stint_id"))
            .agg(*self._sums("h_", F.col("home")), *self._sums("a_", ~F.col("home")))
        )
        joined = self._all_stints().join(sums, ["match_id", "stint_id"], "left")
        head = ["match_id", "stint_id", "nperiod", "start_clk", "end_clk"]
        if with_lineups:
            members = (
                self.lineups()
                .groupBy("match_id", "stint_id")
                .agg(
                    F.array_sort(F.collect_set(F.when(F.col("home"), F.col("player_id")))).alias("home_lineup"),
                    F.array_sort(F.collect_set(F.when(~F.col("home"), F.col("player_id")))).alias("away_lineup"),
                )
            )
            joined = joined.join(members, ["match_id", "stint_id"], "left")
            head += ["home_lineup", "away_lineup"]
        return joined.select(*head, *self._filled("h_"), *self._filled("a_"))


def stint_tables(
    log: DataFrame,
    sides: DataFrame | None = None,
    scoring: dict[str, dict[str, int]] = SCORING,
    chunk_rows: int = DEFAULT_CHUNK_ROWS,
    match_columns: Sequence[str] = (),
) -> StintTables:
    """Annotate a log.

    ``log`` has ``LOG_COLUMNS``: ``kind`` as in ``rules.event_kind``, ``tie`` to order equal
    ``seq``. ``sides`` gives ``home_id`` and ``away_id`` per ``match_id`` (events of other
    matches are left out) and the ``match_columns`` to hand on; without it the log brings a
    boolean ``home``.
    """
    log = log.filter((F.col("kind") != "IGNORE") & F.col("match_id").isNotNull())
    extras = () if sides is None else ("home_id", "away_id", *match_columns)
    split = split_hot_keys(log, "match_id", ORDER, chunk_rows)
    annotated = _annotate(_with_side(split.ordinary, sides, extras), False, extras)
    if split.hot is not None:
        hot_sides = sides if sides is None else split.few_hot_keys(sides, "match_id")
        annotated = annotated.unionByName(_annotate(_with_side(split.hot, hot_sides, extras), True, extras))
    return StintTables(annotated, split.hot is not None, scoring, extras, tuple(match_columns))


def _with_side(rows: DataFrame, sides: DataFrame | None, extras: Sequence[str]) -> DataFrame:
    if sides is None:
        return rows
    joined = rows.join(sides.select("match_id", *extras), "match_id")
    return joined.withColumn("home", F.coalesce(F.col("team_id") == F.col("home_id"), F.lit(False)))


def box_score(log: DataFrame, scoring: dict[str, dict[str, int]] = SCORING) -> DataFrame:
    """Counters per match and player over all scored events, on court or not."""
    used = [s for s in STATS if any(s in adds for adds in scoring.values())]
    sums = (
        log.filter((F.col("kind") == "PLAY") & F.col("code").isin(*scoring) & (F.col("player_id").cast("string") != ""))
        .groupBy("match_id", "player_id")
        .agg(*[F.sum(stat_increment(F.col("code"), s, scoring)).alias(s) for s in used])
    )
    zero = F.lit(0).cast("bigint")
    return sums.select("match_id", "player_id", *[(F.col(s) if s in used else zero).alias(s) for s in STATS])
