"""Game records as text: header tags, time controls, the filter cascade, movetext and its comments. All native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..config import Config, TimeControls

#: Game results as they end a movetext (fixed values).
RESULTS = ("1-0", "0-1", "1/2-1/2", "*")
TAGS = ("Event", "Site", "White", "Black", "Result", "UTCDate", "UTCTime", "WhiteElo", "BlackElo", "WhiteTitle", "BlackTitle", "ECO", "Opening", "TimeControl", "Termination", "Variant")


def extract(text: Column, pattern: str, group: int = 1) -> Column:
    """The first match's group; null where nothing matches or the group is empty."""
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _by_lines(head: Column, name: str) -> Column:
    """The value of the last complete line [name "value"], by a pattern."""
    line = rf'(?s)^.*\n\[{name} "([^\n]*)"\] *(?:\n|\z)'
    return F.when(F.rlike(head, F.lit(line)), F.regexp_extract(head, line, 1))


def tag(head: Column, name: str) -> Column:
    """A header tag's value, of the last line [name "value"] that is complete; empty if present but empty, null if absent.

    head: lines without carriage returns, after a line feed. The last line that begins like the tag is cut out by two searches; only if it isn't complete are the others looked at. Both stay in generated code.
    """
    begin = f'\n[{name} "'
    line = F.rtrim(F.substring_index(F.substring_index(head, begin, -1), "\n", 1))
    whole = F.endswith(line, F.lit('"]'))
    return F.when(F.contains(head, F.lit(begin)), F.when(whole, F.left(line, F.length(line) - 2)).otherwise(_by_lines(head, name)))


def head_of(text: Column) -> Column:
    return F.substring_index(text, "\n\n", 1)


def movetext_of(text: Column) -> Column:
    """What follows the first blank line, trimmed; empty if there is none."""
    at = F.instr(text, "\n\n")
    return F.when(at > 0, F.btrim(F.substr(text, at + 2), F.lit(" \t\r\n"))).otherwise(F.lit(""))


def rating(value: Column) -> Column:
    """Digits only, else null."""
    return F.when(value.rlike(r"^[0-9]{1,9}$"), value.cast("int"))


def site_id(site: Column) -> Column:
    """The eight word characters after the last slash."""
    # fixed value: what counts as a site's id must equal the reference's, so its pattern is used as it is
    return extract(site, r"/(\w{8})$")


def base_seconds(control: Column) -> Column:
    return extract(F.trim(control), r"^(\d{1,9})\+(\d{1,9})$", 1).cast("int")


def increment_seconds(control: Column) -> Column:
    return extract(F.trim(control), r"^(\d{1,9})\+(\d{1,9})$", 2).cast("int")


def estimated_seconds(base: Column, increment: Column, weight: int = 40) -> Column:
    return base + weight * increment


def speed_class(base: Column, increment: Column, cfg: TimeControls | None = None) -> Column:
    """The first class whose bound reaches the estimate; null beyond the last and for null input."""
    cfg = cfg or TimeControls()
    estimate, out = estimated_seconds(base, increment, cfg.increment_weight), F
    for label, bound in cfg.bounds:
        out = out.when(estimate <= bound, label)
    return out


def date_of(value: Column) -> Column:
    """A dotted date; null if it isn't one."""
    return F.try_to_date(value, "yyyy.MM.dd") if hasattr(F, "try_to_date") else F.to_date(F.when(value.rlike(r"^\d{4}\.\d{2}\.\d{2}$"), value), "yyyy.MM.dd")


def month_of_path(path: Column) -> Column:
    return extract(path, r"(\d{4}-\d{2})")


def parsed_headers(records: DataFrame, text: str = "value") -> DataFrame:
    """One column for each tag and the movetext, of records in column `text`."""
    head = F.concat(F.lit("\n"), F.replace(head_of(F.col(text)), F.lit("\r"), F.lit("")))
    read = records.select(head.alias("_head"), movetext_of(F.col(text)).alias("movetext"))
    return read.select(*(tag(F.col("_head"), t).alias(t) for t in TAGS), "movetext")


def _typed(headers: DataFrame, cfg: Config) -> DataFrame:
    """Headers with the values that several rules ask for, each worked out once."""
    out = headers.withColumns({"_base": base_seconds(F.col("TimeControl")), "_inc": increment_seconds(F.col("TimeControl")), "_we": rating(F.col("WhiteElo")), "_be": rating(F.col("BlackElo")), "_id": site_id(F.col("Site"))})
    return out.withColumn("_class", speed_class(F.col("_base"), F.col("_inc"), cfg.time_controls))


def drop_reason(cfg: Config) -> Column:
    """Why a record with typed headers is dropped, by the first rule that it fails; `kept` if none."""
    f, tc = cfg.filter, cfg.time_controls
    label, elos = F.col("_class"), (F.col("_we"), F.col("_be"))
    result = F.coalesce(F.col("Result"), F.lit(""))
    month = F.replace(F.substring(F.coalesce("UTCDate", F.lit("")), 1, 7), F.lit("."), F.lit("-"))
    none = F.lit(False)
    title = F.coalesce(F.col("WhiteTitle").isin(*f.exclude_titles), none) | F.coalesce(F.col("BlackTitle").isin(*f.exclude_titles), none)
    rules = [
        ((F.col("movetext") == "") | (result == "") | ~F.endswith(F.col("movetext"), result), "incomplete"),
        (F.coalesce(F.col("Variant"), F.lit("Standard")) != "Standard", "variant"),
        (month < f.min_month, "before_min_month"),
        (F.col("_base").isNull(), "no_time_control"),
        (F.coalesce(~label.isin(*tc.collected), F.lit(True)), F.concat(F.lit("class_"), F.coalesce(label, F.lit("correspondence")))),
        (elos[0].isNull() | elos[1].isNull(), "missing_elo"),
        (~(elos[0].between(f.min_elo, f.max_elo) & elos[1].between(f.min_elo, f.max_elo)), "elo_out_of_range"),
        (title, "excluded_title"),
        (F.coalesce(F.col("Termination").isin(*f.exclude_terminations), none), "excluded_termination"),
        (F.lit(f.require_clock) & ~F.contains(F.col("movetext"), F.lit("[%clk ")), "no_clock"),
        (F.col("_id").isNull(), "no_game_id"),
    ]
    out = F
    for condition, label in rules:
        out = out.when(condition, label)
    return out.otherwise("kept")


def with_reason(records: DataFrame, cfg: Config | None = None, text: str = "value") -> DataFrame:
    """Parsed headers of every record with `reason`.

    The reason comes out of a generator, so that a condition on it isn't moved below the parsing: there every use of a tag would be the tag's whole expression again, in code too large to be compiled.
    """
    cfg = cfg or Config()
    typed = _typed(parsed_headers(records, text), cfg)
    return typed.select("*", F.explode(F.array(drop_reason(cfg))).alias("reason")).drop("_base", "_inc", "_we", "_be", "_id", "_class")


def kept_games(marked: DataFrame, cfg: Config | None = None) -> DataFrame:
    """The typed table of the kept records."""
    cfg = cfg or Config()
    base, inc = base_seconds(F.col("TimeControl")), increment_seconds(F.col("TimeControl"))
    blank = lambda c: F.coalesce(F.col(c), F.lit(""))
    return marked.where("reason = 'kept'").select(
        site_id(F.col("Site")).alias("game_id"),
        date_of(F.col("UTCDate")).alias("utc_date"),
        blank("UTCTime").alias("utc_time"),
        blank("Event").alias("event"),
        blank("White").alias("white"),
        blank("Black").alias("black"),
        rating(F.col("WhiteElo")).cast("short").alias("white_elo"),
        rating(F.col("BlackElo")).cast("short").alias("black_elo"),
        F.col("WhiteTitle").alias("white_title"),
        F.col("BlackTitle").alias("black_title"),
        blank("Result").alias("result"),
        blank("Termination").alias("termination"),
        blank("ECO").alias("eco"),
        blank("Opening").alias("opening"),
        base.alias("base_s"),
        inc.cast("short").alias("increment_s"),
        speed_class(base, inc, cfg.time_controls).alias("tc_class"),
        F.contains(F.col("movetext"), F.lit("[%eval ")).alias("has_evals"),
        "movetext",
    )


# --- movetext ---


def clock_seconds(comment: Column) -> Column:
    """Seconds of a [%clk H:MM:SS] comment; null if it has none."""
    # fixed value: what counts as a clock comment must equal the reference's, so its pattern is used as it is
    part = lambda i: extract(comment, r"\[%clk (\d+):(\d\d):(\d\d(?:\.\d+)?)\]", i)
    return part(1).cast("int") * 3600 + part(2).cast("int") * 60 + part(3).cast("double")


def eval_centipawns(comment: Column) -> Column:
    """A [%eval x.y] comment in centipawns, rounded half to even; null for mates."""
    return F.bround(extract(comment, r"\[%eval (-?\d+(?:\.\d+)?)\]").cast("double") * 100, 0).cast("int")


def eval_mate(comment: Column) -> Column:
    return extract(comment, r"\[%eval #(-?\d+)\]").cast("int")


def move_tokens(movetext: Column) -> Column:
    """array<struct<san, clock_s, cp, mate>>: each move with what the comments before the next one say; of several, the last."""
    tokens = F.regexp_extract_all(movetext, F.lit(r"\{[^}]*\}|\S+"), F.lit(0))
    noise = lambda t: t.isin(*RESULTS) | t.rlike(r"^\d+\.(\.\.)?$") | F.startswith(t, F.lit("$"))
    is_comment = lambda t: F.startswith(t, F.lit("{")) & F.endswith(t, F.lit("}"))
    kept = F.filter(tokens, lambda t: is_comment(t) | ~noise(t))
    move = lambda t: F.struct(F.regexp_replace(t, r"[?!]+$", "").alias("san"), F.lit(None).cast("double").alias("clock_s"), F.lit(None).cast("int").alias("cp"), F.lit(None).cast("int").alias("mate"))

    def fold(state, t):
        last = state["last"]
        merged = F.struct(last["san"].alias("san"), F.coalesce(clock_seconds(t), last["clock_s"]).alias("clock_s"), F.coalesce(eval_centipawns(t), last["cp"]).alias("cp"), F.coalesce(eval_mate(t), last["mate"]).alias("mate"))
        done = F.when(last.isNull(), state["done"]).otherwise(F.concat(state["done"], F.array(last)))
        return F.when(is_comment(t), F.struct(state["done"].alias("done"), F.when(last.isNotNull(), merged).alias("last"))).otherwise(F.struct(done.alias("done"), move(t).alias("last")))

    kind = "array<struct<san:string,clock_s:double,cp:int,mate:int>>"
    start = F.struct(F.array().cast(kind).alias("done"), F.lit(None).cast(kind[6:-1]).alias("last"))
    return F.aggregate(kept, start, fold, lambda s: F.when(s["last"].isNull(), s["done"]).otherwise(F.concat(s["done"], F.array(s["last"]))))


def read_clocks(tokens: Column) -> Column:
    """The clocks of a game's moves; null if one is missing."""
    return F.when(~F.exists(tokens, lambda m: m["clock_s"].isNull()), F.transform(tokens, lambda m: m["clock_s"]))
