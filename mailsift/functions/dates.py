"""RFC 2822 date parsing as native Spark expressions.

Grammar accepted: [weekday[,]] day month year hh:mm[:ss] [zone] [anything], with a
2-digit year mapped 69-99 -> 19xx and 00-68 -> 20xx. Zones: +hhmm/-hhmm, the named US
zones and UT/UTC/GMT/Z. '-0000', an unknown name or no zone gives a naive time, which
``date_utc`` reads as UTC. ISO-8601 input and a bare date do not parse.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Month names (abbreviated and full) and named zones in minutes east of UTC.
MONTHS = ("jan", "feb", "mar", "apr", "may", "jun", "jul", "aug", "sep", "oct", "nov", "dec",
          "january", "february", "march", "april", "may", "june", "july", "august",
          "september", "october", "november", "december")
ZONES = {"UT": 0, "UTC": 0, "GMT": 0, "Z": 0, "AST": -240, "ADT": -180, "EST": -300,
         "EDT": -240, "CST": -360, "CDT": -300, "MST": -420, "MDT": -360, "PST": -480,
         "PDT": -420}

_DATE_RE = (r"^\s*(?:[A-Za-z]+\s*,\s*|[A-Za-z]+\s+)?(\d{1,2})\s+([A-Za-z]+)\s+(\d{2,4})\s+"
            r"(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?(?:\s+([A-Za-z]+|[+-]\d{4}))?(?:\s.*)?$")


# asctime form: weekday month day hh:mm[:ss] year (no zone: naive).
_ASCTIME_RE = (r"^\s*[A-Za-z]+\s+([A-Za-z]+)\s+(\d{1,2})\s+(\d{1,2}):(\d{1,2})(?::(\d{1,2}))?"
               r"\s+(\d{2,4})\s*$")


def _g(v: Column, k: int) -> Column:
    return F.regexp_extract(v, _DATE_RE, k)


# Other orders that mail carries, as (pattern, rewrite into day month year time zone).
_TIME = r"\d{1,2}:\d{1,2}(?::\d{1,2})?"
_REWRITES = (
    # 09.00.00 and a zone without a space before it
    (r"^(.*\d{2,4}\s+\d{1,2})\.(\d{1,2})(?:\.(\d{1,2}))?((?:\s.*)?)$", r"$1:$2:$3$4"),
    (r"^(.*\d):(\s.*|)$", r"$1$2"),
    (r"^(.*:\d{1,2})([+-]\d{4}.*)$", r"$1 $2"),
    # Monday, 05-Jan-2026 09:00:00 GMT
    (rf"^\s*(?:[A-Za-z]+,?\s+)?(\d{{1,2}})-([A-Za-z]+)-(\d{{2,4}})\s+({_TIME})\s+(\S+)\s*$", r"$1 $2 $3 $4 $5"),
    # Mon Jan 5 09:00:00 EST 2026
    (rf"^\s*[A-Za-z]+\s+([A-Za-z]+)\s+(\d{{1,2}})\s+({_TIME})\s+([A-Za-z]+|[+-]\d{{4}})\s+(\d{{2,4}})\s*$", r"$2 $1 $5 $3 $4"),
    # Jan 5 2026 09:00, with or without a weekday or a comma
    (rf"^\s*(?:[A-Za-z]+,?\s+)?([A-Za-z]+)\s+(\d{{1,2}}),?\s+(\d{{4}})\s+({_TIME})((?:\s.*)?)$", r"$2 $1 $3 $4$5"),
)


def _to_rfc(v: Column) -> Column:
    """Rewrite an asctime or otherwise ordered date into the RFC order (day month year time)."""
    for pattern, rewrite in _REWRITES:
        v = F.regexp_replace(v, pattern, rewrite)
    return F.when(v.rlike(_ASCTIME_RE), F.regexp_replace(
        v, _ASCTIME_RE, "$2 $1 $6 $3:$4:$5")).otherwise(v)


def parse_parts(value: Column) -> Column:
    """STRUCT(local TIMESTAMP, offset_min INT or NULL for naive); NULL if unparseable."""
    v = _to_rfc(F.coalesce(value, F.lit("")))
    ok = v.rlike(_DATE_RE)
    mon_name = F.lower(_g(v, 2))
    mon = F.array_position(F.array(*[F.lit(m) for m in MONTHS]), mon_name)
    mon = F.when(mon > 12, mon - 12).otherwise(mon)
    yy = _g(v, 3).try_cast("int")
    yy = F.when(yy < 100, F.when(yy > 68, yy + 1900).otherwise(yy + 2000)).otherwise(yy)
    ss = F.when(_g(v, 6) == "", F.lit(0)).otherwise(_g(v, 6).try_cast("int"))
    text = F.format_string("%04d-%02d-%02d %02d:%02d:%02d", yy, mon, _g(v, 1).try_cast("int"),
                           _g(v, 4).try_cast("int"), _g(v, 5).try_cast("int"), ss)
    local = F.try_to_timestamp(text, F.lit("yyyy-MM-dd HH:mm:ss"))
    zone = F.upper(_g(v, 7))
    zmap = F.create_map(*[x for k, m in ZONES.items() for x in (F.lit(k), F.lit(m))])
    numeric = zone.rlike(r"^[+-]\d{4}$")
    sign = F.when(zone.startswith("-"), F.lit(-1)).otherwise(F.lit(1))
    num_off = sign * (zone.substr(2, 2).try_cast("int") * 60 + zone.substr(4, 2).try_cast("int"))
    offset = F.when(numeric & (zone == "-0000"), F.lit(None).try_cast("int")) \
        .when(numeric, num_off).otherwise(F.try_element_at(zmap, zone))
    return F.when(ok & (mon > 0) & local.isNotNull(),
                  F.struct(local.alias("local"), offset.try_cast("int").alias("offset_min")))


def date_iso(value: Column) -> Column:
    """ISO-8601 keeping the source offset (no offset when naive); '' on failure."""
    return iso_from_parts(parse_parts(value))


def iso_from_parts(p: Column) -> Column:
    """``date_iso`` from an already parsed STRUCT(local, offset_min)."""
    off = p["offset_min"]
    off_txt = F.when(off.isNull(), F.lit("")).otherwise(F.format_string(
        "%s%02d:%02d", F.when(off < 0, "-").otherwise("+"), F.floor(F.abs(off) / 60).cast("int"),
        F.abs(off) % 60))
    iso = F.concat(F.date_format(p["local"], "yyyy-MM-dd'T'HH:mm:ss"), off_txt)
    return F.coalesce(iso, F.lit(""))


def date_utc(value: Column) -> Column:
    """UTC TIMESTAMP; a naive time is taken as UTC; NULL on failure."""
    return utc_from_parts(parse_parts(value))


def utc_from_parts(p: Column) -> Column:
    """``date_utc`` from an already parsed STRUCT(local, offset_min)."""
    return F.timestamp_add("MINUTE", -F.coalesce(p["offset_min"], F.lit(0)), p["local"])
