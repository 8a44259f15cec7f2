"""Mixed timestamp formats and time zones -> one instant in UTC.

Everything is a JVM expression: a value is rewritten to ``Y|M|D|time tail`` by the first shape it
has, the tail is split once, and ``try_make_timestamp`` resolves the wall clock in its zone. The JVM's
zone rules give the documented results for the two odd hours of a year: a wall clock time that occurs
twice is the earlier instant, one that is skipped is read with the offset before the change.

Zones of values that state none come from an *offset history* per source: a zone of the IANA database (a list of offsets with their dates of change).
``zone_history`` estimates it by alignment. Whatever puts an instant beside a local time of the source is an observation: a value of the source that states its own offset or
zone, or another delivery of the same item whose instant is known; and a local time near its ingestion must not lie after it (an item cannot be published after it was fetched). Each distinct offset history of the IANA
database is tried on them, and the one that fewest observations violate wins; among equals the least delay of what was fetched within a day of publication. A zone declared in the registry takes precedence over
the estimate, as the registry is authoritative where it has an entry.
"""

from __future__ import annotations

from pyspark import SparkContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vigilake.tables import small

# Names of the months in the six languages of the feeds (first letters that tell them apart).
MONTHS = (
    "january janvier januar enero janeiro jan|1 february février fevrier februar febrero fevereiro feb fév fev|2 "
    "march mars märz maerz marzo março marco mar mär|3 april avril abril apr avr abr|4 may mai mayo maio|5 "
    "june juin juni junio junho jun|6 july juillet juli julio julho jul juil|7 august août aout agosto aug ago|8 "
    "september septembre septiembre setembro sep sept set|9 october octobre oktober octubre outubro oct okt out|10 "
    "november novembre noviembre novembro nov|11 december décembre decembre dezember diciembre dezembro dec déc dez dic|12"
)
# Zone abbreviations and their offset in minutes; a second list for Australia, where EST and CST differ.
ABBREVIATIONS = {
    "utc": 0, "gmt": 0, "z": 0, "ut": 0, "wet": 0, "west": 60, "bst": 60, "cet": 60, "cest": 120, "mez": 60, "mesz": 120,
    "eet": 120, "eest": 180, "msk": 180, "ist": 330, "jst": 540, "kst": 540, "hkt": 480, "sgt": 480, "awst": 480,
    "acst": 570, "acdt": 630, "aest": 600, "aedt": 660, "nzst": 720, "nzdt": 780, "est": -300, "edt": -240, "cst": -360,
    "cdt": -300, "mst": -420, "mdt": -360, "pst": -480, "pdt": -420, "akst": -540, "akdt": -480, "hst": -600, "ast": -240,
    "adt": -180, "nst": -210, "ndt": -150, "brt": -180,
}
BY_COUNTRY = {
    ("australia/", "est"): 600, ("australia/", "edt"): 660, ("australia/", "cst"): 570, ("australia/", "cdt"): 630,
    ("australia/", "wst"): 480, ("asia/shanghai", "cst"): 480, ("asia/taipei", "cst"): 480, ("europe/dublin", "ist"): 60,
    ("asia/jerusalem", "ist"): 120, ("asia/dhaka", "bst"): 360,
}

CANONICAL = r"^\d{4}-\d\d-\d\dT\d\d:\d\d:\d\d(\.\d{1,6})?Z$"
_WORD = r"\p{L}+"
_DAY = rf"(?:{_WORD}\.?,? )?"
# Shape -> rewrite to Y|M|D|tail. The first that matches holds; "a/b" for M leaves the order to the source.
_SHAPES = [(r"(?iu)^" + a + "$", b) for a, b in (
    (r"(\d{4})-(\d{1,2})-(\d{1,2})(?:(?:t| ) ?(.*))?", "$1|$2|$3|$4"),
    (r"(\d{4})(\d\d)(\d\d)(?:(?:t| )(\d\d):?(\d\d):?(\d\d)?(.*))?", "$1|$2|$3|$4:$5:$6$7"),
    (r"(\d{4})/(\d{1,2})/(\d{1,2})(?:,? (.*))?", "$1|$2|$3|$4"),
    (r"(\d{1,2})/(\d{1,2})/(\d{4}|\d\d)(?:,? (.*))?", "$3|$1/$2||$4"),
    (r"(\d{1,2})\.(\d{1,2})\.(\d{4}|\d\d)(?:,? (.*))?", "$3|$2|$1|$4"),
    (r"(\d{4})年 ?(\d{1,2})月 ?(\d{1,2})日(?: ?(\d{1,2})時(\d{1,2})分(?:(\d{1,2})秒)?)?(.*)", "$1|$2|$3|$4:$5:$6$7"),
    (_DAY + rf"(\d{{1,2}})(?:\.|st|nd|rd|th|er)?[ -](?:de )?({_WORD})\.?,?[ -](?:de )?(\d{{4}}|\d\d)(?:,? (?:(?:à|um|a las|às|at) )?(.*))?", "$3|$2|$1|$4"),
    (_DAY + rf"({_WORD})\.? (\d{{1,2}})(?:st|nd|rd|th)?, ?(\d{{4}})(?:,? (?:at )?(.*))?", "$3|$1|$2|$4"),
    (rf"{_WORD} ({_WORD}) (\d{{1,2}}) (\d{{1,2}}:\d\d:\d\d(?:\.\d+)?(?: \S+)?) (\d{{4}})", "$4|$1|$2|$3"),
)]
_TAIL = (
    r"(?iu)^(?:(\d{1,2})(?:[:h.](\d\d))?(?::(\d\d))?(?:[.,](\d{1,12}))?)?:{0,2} ?(?:([ap])\.?m\b\.?)? ?(?:uhr\b|h\b)? ?"
    r"([+-]\d{1,2}(?::?\d\d)?|(?:utc|gmt)[+-]\d{1,2}(?::?\d\d)?|[a-z]{1,5}|[a-z]+(?:/[a-z0-9_+-]+){1,2})? ?(?:\[([a-z0-9_/+-]+)\])? ?(?:\([a-z ]*\))?$"
)


def _map(pairs: dict) -> Column:
    return F.create_map(*[F.lit(x) for kv in pairs.items() for x in kv])


def _month_map() -> Column:
    pairs: dict[str, int] = {}
    waiting: list[str] = []
    for word in MONTHS.split():
        name, _, number = word.partition("|")
        waiting.append(name)
        if number:
            pairs |= dict.fromkeys(waiting, int(number))
            waiting = []
    return _map(pairs)


def clean(raw: Column) -> Column:
    """``raw`` with plain digits and single spaces, nothing around it."""
    wide, thin = "０１２３４５６７８９：／－\u2212\u2010\u2011", "0123456789:/----"
    return F.trim(F.regexp_replace(F.translate(raw, wide, thin), r"[\s\p{Z}]+", " "))


def let(value: Column, body) -> Column:
    """``body(value)`` with ``value`` computed once, however often ``body`` uses it (Catalyst would inline a projection)."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _zones() -> list[str]:
    """The names of zones that the JVM knows; it fails on any other."""
    return sorted(SparkContext._active_spark_context._jvm.java.time.ZoneId.getAvailableZoneIds())


def _blank(c: Column) -> Column:
    return F.when(c != "", c)


def _int(c: Column) -> Column:
    return F.coalesce(_blank(c).try_cast("int"), F.lit(0))


def _epoch(v: Column) -> Column:
    """Microseconds of a bare number of 9 to 19 digits, by its length; digits beyond microseconds are dropped."""
    whole = F.split_part(v, F.lit("."), F.lit(1))
    micros = F.rpad(F.substring(F.split_part(v, F.lit("."), F.lit(2)), 1, 6), 6, "0")
    n = F.length(whole)
    scaled = F.when(n <= 11, F.concat(whole, micros)).when(n <= 14, F.concat(whole, F.substring(micros, 1, 3))).when(n <= 17, whole)
    return scaled.otherwise(F.regexp_replace(whole, r"\d{3}$", "")).try_cast("long")


def instant(value: Column, zone: Column, date_order: Column, home: Column | None = None) -> Column:
    """The instant that the text ``value`` denotes, in microseconds since 1970 UTC.

    ``zone``: zone of a value that states none. ``date_order``: ``mdy`` or ``dmy`` (null: ``dmy``), for all-numeric
    dates with slashes. ``home``: zone of the publisher, which tells the country for abbreviations (null: ``zone``).
    Null where the value is null, blank or denotes no real date (0000-00-00, 30 February, words).
    A day alone is 00:00:00; digits beyond microseconds are dropped; a wrong weekday is ignored; a bare number of
    9 to 19 digits counts seconds, milliseconds, microseconds or nanoseconds from 1970 by its length, eight digits
    are a calendar date. Very long texts match no shape and give null.
    """
    home = F.lower(zone if home is None else home)
    day_leads = F.coalesce(F.lower(date_order) != "mdy", F.lit(True))

    def shape(v: Column) -> Column:
        out = F.lit(None).cast("string")
        for pattern, rewrite in reversed(_SHAPES):
            out = F.when(v.rlike(pattern), F.regexp_replace(v, pattern, rewrite)).otherwise(out)
        return F.split(out, r"\|", -1)

    def time_of(p: Column) -> Column:
        return F.when(p[3].rlike(_TAIL), F.split(F.regexp_replace(p[3], _TAIL, "$1|$2|$3|$4|$5|$6|$7"), r"\|", -1))

    def resolve(p: Column, w: Column) -> Column:
        slash = p[1].contains("/")
        a, b = F.split_part(p[1], F.lit("/"), F.lit(1)).try_cast("int"), F.split_part(p[1], F.lit("/"), F.lit(2)).try_cast("int")
        month = F.when(slash, F.when(day_leads, b).otherwise(a)).otherwise(F.coalesce(p[1].try_cast("int"), _month_map()[F.lower(p[1])]))
        day = F.when(slash, F.when(day_leads, a).otherwise(b)).otherwise(p[2].try_cast("int"))
        year = F.when(F.length(p[0]) == 2, F.concat(F.lit("20"), p[0])).otherwise(p[0]).try_cast("int")
        h12 = _int(w[0])
        hour = F.when(w[4] == "", h12).when(h12.between(1, 12), h12 % 12 + F.when(F.lower(w[4]) == "p", 12).otherwise(0))
        micro = F.rpad(F.substring(w[3], 1, 6), 6, "0")
        second = F.concat(F.lpad(w[2], 2, "0"), F.lit("."), micro).try_cast("decimal(16,6)")
        stated, bracket = F.lower(w[5]), w[6]
        offset = r"^(?:utc|gmt)?([+-])(\d{1,2}):?(\d\d)?$"
        sign = F.when(F.regexp_extract(stated, offset, 1) == "-", -1).otherwise(1)
        by_offset = F.when(stated.rlike(offset), sign * (_int(F.regexp_extract(stated, offset, 2)) * 60 + _int(F.regexp_extract(stated, offset, 3))))
        by_country = F.lit(None).cast("int")
        for (country, name), minutes in BY_COUNTRY.items():
            by_country = F.when(home.startswith(country) & (stated == name), minutes).otherwise(by_country)
        minutes = F.coalesce(by_offset, by_country, _map(ABBREVIATIONS)[stated])
        named = F.when(stated.contains("/"), w[5]).when(stated == "", _blank(bracket))
        named = F.when(F.lower(named) == "utc", F.lit("UTC")).otherwise(named)
        where = F.when(minutes.isNotNull(), F.lit("UTC")).when(named.isNotNull(), named).when(stated == "", F.coalesce(zone, F.lit("UTC")))
        stamp = F.try_make_timestamp(year, month, day, hour, _int(w[1]), second, F.when(where.isin(*_zones()), where))
        return F.when(year >= 1, F.unix_micros(stamp) - F.coalesce(minutes, F.lit(0)).cast("long") * 60_000_000)

    def parse(v: Column) -> Column:
        shaped = let(shape(v), lambda p: let(time_of(p), lambda w: resolve(p, w)))
        return F.when(v.rlike(r"^\d{9,19}(\.\d+)?$"), _epoch(v)).otherwise(shaped)

    return let(F.when(F.length(value) < 200, clean(value)), parse)


_HOUR = 3_600_000_000
#: Zones lie between 12 hours before and 14 after UTC, so only a local time this near to an ingestion can tell one zone from another.
_REACH = 38 * _HOUR


def offset_histories(spark: SparkSession, first: list[str], since: int = 2000, until: int = 2036) -> list[str]:
    """One zone of each distinct offset history of the IANA database between the two years: the zones ``first`` if they are of it, else the first by name."""
    names = [z for z in _zones() if "/" in z and not z.startswith(("Etc/", "SystemV/")) or z == "UTC"]
    days = spark.range((until - since) * 365 // 5).select(F.expr(f"timestamp'{since}-01-01 00:00:00' + make_interval(0, 0, 0, cast(id * 5 as int))").alias("t"))
    offsets = days.select("t", F.explode(F.array(*map(F.lit, names))).alias("zone")).select("zone", F.xxhash64("t", F.unix_micros(F.from_utc_timestamp("t", F.col("zone"))) - F.unix_micros("t")).alias("h"))
    # The names are some 600 and the histories fewer, whatever the data.
    known = {r["zone"]: r["h"] for r in offsets.groupBy("zone").agg(F.bit_xor("h").alias("h")).collect()}
    best: dict[int, str] = {}
    for z in [z for z in first if z in known] + sorted(known):
        best.setdefault(known[z], z)
    return [z for z in first if z in best.values()] + sorted(z for z in best.values() if z not in first)


def observations(rows: DataFrame) -> DataFrame:
    """``(source, at, minutes, n)``: at the hour ``at`` (micros) the clock of ``source`` was ``minutes`` ahead of UTC, seen ``n`` times.

    From values that state an offset, zone or unambiguous abbreviation (UTC and GMT, which publishers anywhere convert to, aside), and, if there is a ``guid``, from local times whose item came with an instant as well. An item's instants
    are only its first and last, so a guid that many rows share makes no pairs. Null sources and guids say nothing.
    """
    bare = F.regexp_replace("published_date", _STATED_TAIL, "")
    v = clean(F.col("published_date"))
    unclear = "|".join(sorted({name for _, name in BY_COUNTRY}))
    plain, minute = F.lit("UTC"), 60_000_000
    read = rows.where("source is not null and published_date is not null").withColumn("published_date", v).withColumn("states", F.col("published_date").rlike(_STATES_ZONE))
    read = read.select("*", instant(F.col("published_date"), plain, F.col("date_order")).alias("t"), F.when(F.col("states") & ~F.col("published_date").rlike(r"(?i)(?:\b(?:" + unclear + r")|[0-9 ]z|\butc|\bgmt)$"), instant(bare, plain, F.col("date_order"))).alias("wall"), F.col("published_date").contains(":").alias("timed"))
    own = read.where("states and timed").where(F.col("published_date").rlike(r"(?i)[a-z]/[a-z]|\bwet$") | (F.floor(F.col("wall") / minute) != F.floor(F.col("t") / minute))).select("source", "t", "wall")
    pairs = own
    if "guid" in rows.columns:
        known = read.where("states and guid is not null").groupBy("source", "guid").agg(F.array_distinct(F.array(F.min("t"), F.max("t"))).alias("ts"))
        local = read.where("not states and timed and guid is not null").select("source", "guid", F.col("t").alias("wall"))
        pairs = own.unionByName(local.join(known, ["source", "guid"]).select("source", F.explode("ts").alias("t"), "wall"))
    ahead = F.floor(F.col("wall") / minute) - F.floor(F.col("t") / minute)
    seen = pairs.select("source", (F.floor(F.col("t") / _HOUR) * _HOUR).alias("at"), ahead.alias("minutes")).where("minutes % 15 = 0 and minutes between -720 and 840")
    return seen.groupBy("source", "at", "minutes").agg(F.count("*").alias("n"))


def zone_history(observed: DataFrame, arrivals: DataFrame, zones: list[str]) -> DataFrame:
    """Estimated offset history per source: ``(source, zone, violations, n_rows, median_delay_s)``, one row per source with an observation or arrival.

    ``observed`` as ``observations`` gives it; ``arrivals`` has ``(source, w, i)``, a local time read as if it were UTC and the instant of ingestion, in microseconds. Each of ``zones``, in order of preference, is
    tried on every observation (a fixed list, so rows grow by a constant; observations are counts by hour already) and on the arrivals near enough to tell. The zone with the fewest
    violations wins, then the least median delay of what arrived within a day, then the earlier in ``zones``. Null sources are one source.
    """
    every = F.array(*[F.struct(F.lit(k).alias("rank"), F.lit(z).alias("zone")) for k, z in enumerate(zones)])
    near = arrivals.where(F.abs(F.col("i") - F.col("w")) <= _REACH).select("source", "w", "i", F.explode(every).alias("z")).select("source", "w", "i", "z.*")
    delay = (F.col("i") - F.unix_micros(F.to_utc_timestamp(F.timestamp_micros("w"), F.col("zone")))) / 1e6
    late = near.select("source", "rank", "zone", F.when(delay < 0, 1).otherwise(0).alias("bad"), F.lit(1).alias("n"), F.when((delay >= 0) & (delay < 86_400), delay).alias("delay"))
    at = observed.select("source", "at", "minutes", "n", F.explode(every).alias("z")).select("source", "at", "minutes", "n", "z.*")
    ahead = (F.unix_micros(F.from_utc_timestamp(F.timestamp_micros("at"), F.col("zone"))) - F.col("at")) / 60_000_000
    wrong = at.select("source", "rank", "zone", F.when(ahead != F.col("minutes"), F.col("n")).otherwise(0).alias("bad"), "n", F.lit(None).cast("double").alias("delay"))
    scored = late.unionByName(wrong).groupBy("source", "rank", "zone").agg(F.sum("bad").alias("violations"), F.sum("n").alias("n_rows"), F.percentile_approx("delay", 0.5, 1000).alias("median_delay_s"))
    best = F.min_by(F.struct("zone", "violations", "n_rows", "median_delay_s"), F.struct("violations", F.coalesce("median_delay_s", F.lit(1e9)).alias("d"), "rank"))
    return scored.groupBy("source").agg(best.alias("b")).select("source", "b.*")


FIELDS = ("published_date", "fetched_at")
_STATES_ZONE = r"(?i)(?:[+-]\d\d:?\d\d|z|\]|/[a-z_]+|(?:utc|gmt)[+-][\d:]+|[a-z]{3,4}|[a-z]{3,4} \d{4})$|^\d{9,}"
_STATED_TAIL = r"(?i) ?(?:(?:(?:utc|gmt)?[+-]\d\d?(?::?\d\d)?|[a-z]{3,5}|[a-z]+(?:/[a-z0-9_+-]+){1,2}) ?)?(?:\[[a-z0-9_/+-]+\])? ?(?:\([a-z ]*\))?$"


def with_zones(signals: DataFrame, sources: DataFrame) -> DataFrame:
    """``signals`` with ``zone`` and ``date_order`` of each row's source.

    The registry's zone holds; a source the registry has without a zone, or not at all, gets the offset history
    that ``zone_history`` estimates from its rows (UTC where it has no usable row).
    """
    registry = sources.select(F.col("source_id").alias("source"), F.col("feed_tz").alias("declared"), "date_order")
    registry = registry.where("source is not null").dropDuplicates(["source"])
    rows = signals.select("row_id", "source", "guid", *FIELDS) if "guid" in signals.columns else signals.select("row_id", "source", *FIELDS)
    rows = rows.join(F.broadcast(registry) if small(sources) else registry, "source", "left")
    # Only sources that the registry can't tell are estimated; mostly there are none.
    if rows.where("declared is null and source is not null").select("source").isEmpty():
        return rows.select("row_id", "source", *FIELDS, F.coalesce("declared", F.lit("UTC")).alias("zone"), "date_order")
    estimate = estimated_zones(rows.where("declared is null"), sources).select("source", "estimated")
    rows = rows.join(F.broadcast(estimate) if small(sources) else estimate, "source", "left")
    return rows.select("row_id", "source", *FIELDS, F.coalesce("declared", "estimated", F.lit("UTC")).alias("zone"), "date_order")


def arrivals(rows: DataFrame) -> DataFrame:
    """``(source, w, i)``: local time and ingestion of each value of ``published_date`` that states no zone."""
    local = rows.where(F.col("published_date").isNotNull() & ~clean(F.col("published_date")).rlike(_STATES_ZONE))
    walls = local.select("source", instant(F.col("published_date"), F.lit("UTC"), F.col("date_order")).alias("w"), instant(F.col("fetched_at"), F.lit("UTC"), F.col("date_order")).alias("i"))
    return walls.where("w is not null and i is not null")


def estimated_zones(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """``(source, estimated, violations, n_rows, median_delay_s)`` from rows with ``date_order`` beside the two fields."""
    # The registry's distinct zones, to name a history by: at most the 600 or so zones of the IANA database, whatever the number of sources.
    registered = sorted(r[0] for r in sources.select("feed_tz").where("feed_tz is not null").distinct().collect())
    zones = offset_histories(rows.sparkSession, registered)
    return zone_history(observations(rows), arrivals(rows), zones).withColumnRenamed("zone", "estimated")


def agreement(signals: DataFrame, sources: DataFrame) -> DataFrame:
    """``(source, declared, estimated, violations, n_rows, n_local, n_same)``: the estimated history of each source beside the registered one, and for how many local times both give the same instant."""
    registry = sources.select(F.col("source_id").alias("source"), F.col("feed_tz").alias("declared"), "date_order").where("source is not null").dropDuplicates(["source"])
    rows = signals.join(F.broadcast(registry) if small(sources) else registry, "source", "left")
    both = registry.join(estimated_zones(rows, sources), "source", "left").select("source", "declared", "estimated", "violations", "n_rows")
    wall = F.timestamp_micros(F.col("w"))
    same = F.to_utc_timestamp(wall, F.coalesce("declared", F.lit("UTC"))) == F.to_utc_timestamp(wall, F.coalesce("estimated", F.lit("UTC")))
    read = arrivals(rows).join(F.broadcast(both) if small(sources) else both, "source").groupBy("source").agg(F.count("*").alias("n_local"), F.sum(same.cast("long")).alias("n_same"))
    return both.join(read, "source", "left").select("source", "declared", "estimated", "violations", "n_rows", F.coalesce("n_local", F.lit(0)).alias("n_local"), F.coalesce("n_same", F.lit(0)).alias("n_same"))


def normalise(signals: DataFrame, sources: DataFrame) -> DataFrame:
    """``(row_id, field, raw, utc_micros)``: one row per non-null value of the two fields; ``utc_micros`` null if it is no date."""
    rows = with_zones(signals, sources)
    pairs = F.array(F.struct(F.lit(FIELDS[0]).alias("field"), F.col(FIELDS[0]).alias("raw"), F.col("zone").alias("z")), F.struct(F.lit(FIELDS[1]).alias("field"), F.col(FIELDS[1]).alias("raw"), F.lit("UTC").alias("z")))
    long = rows.select("row_id", "zone", "date_order", F.explode(pairs).alias("f")).where("f.raw is not null")
    return long.select("row_id", "f.field", "f.raw", instant(F.col("f.raw"), F.col("f.z"), F.col("date_order"), F.col("zone")).alias("utc_micros"))


def found(signals: DataFrame, sources: DataFrame) -> DataFrame:
    """``(row_id, field, utc_micros)`` of each value that denotes an instant and isn't in the canonical form already."""
    done = normalise(signals, sources).where(~F.col("raw").rlike(CANONICAL))
    return done.where("utc_micros is not null").select("row_id", "field", "utc_micros")
