"""Date mentions in Chinese/numeric text (P15, X19-X21), native expressions.

``as_of`` is a timestamp column (not "today"), so results are reproducible
and each row can carry its own reference time.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: numeral characters and units ---------------------------------
CN_DIGITS = "零一二三四五六七八九"          # value = position
CN_UNITS = {"十": 10, "百": 100, "千": 1000, "万": 10000}
RELATIVE_DAYS = {"今天": 0, "明天": 1, "后天": 2}
PM_WORDS = ("下午", "晚上", "中午")
DAY_PART_WORDS = ("上午", "下午", "中午", "早上", "晚上")
MONTH_NAMES = ("jan(?:uary)?", "feb(?:ruary)?", "mar(?:ch)?", "apr(?:il)?", "may", "june?", "july?", "aug(?:ust)?", "sept?(?:ember)?",
               "oct(?:ober)?", "nov(?:ember)?", "dec(?:ember)?")
WEEKDAY_NAMES = ("mon(?:day)?", "tue(?:s|sday)?", "wed(?:nesday)?", "thu(?:rs|rsday)?", "fri(?:day)?", "sat(?:urday)?", "sun(?:day)?")
# ------------------------------------------------------------------------------------

_DIGIT = f"[0-9{CN_DIGITS}]"
_NUMBER = f"[0-9{CN_DIGITS}{''.join(CN_UNITS)}]+"
_HOUR_MARK = "[点时:.]"
_DAY_PART = "|".join(DAY_PART_WORDS)
_RELATIVE = "|".join(RELATIVE_DAYS)
#: one number with the mark of its unit, or a clock reading
_PIECE = f"(?:(?:{_DAY_PART})?{_NUMBER}(?:[年月号日点时分秒:.]))"
MENTION = f"(?:{_RELATIVE})?(?:{_PIECE}+(?:{_NUMBER})?|(?:{_DAY_PART}){_NUMBER})|{_RELATIVE}"
LAYOUTS = ("yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy-MM-dd'T'HH:mm:ss", "yyyy/MM/dd HH:mm:ss", "yyyy/MM/dd HH:mm",
           "yyyy/MM/dd", "yyyy.MM.dd", "yyyyMMdd", "MM/dd/yyyy", "MM/dd/yyyy HH:mm", "d MMM yyyy", "MMM d, yyyy", "MMM d yyyy", "d MMMM yyyy", "MMMM d, yyyy")


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def cn_number(x) -> Column:
    """Leading ASCII digits as an int, else a Chinese numeral. It is cut
    into runs of digits that end at a unit 十百千万 (or at the end, worth 1);
    a run is worth its digit sum times its unit. A first unit that the sum
    does not reach counts once (十 -> 10, 十五 -> 15). 零 alone is 0. Any
    other character gives NULL."""
    s = _c(x)
    units = "".join(CN_UNITS)
    lead = F.regexp_extract(s, r"^(\d+)", 1)
    worth = F.create_map(*[F.lit(v) for kv in CN_UNITS.items() for v in kv])

    def run_value(run):
        plain = F.translate(run, CN_DIGITS, "0123456789")
        digits = sum((F.length(plain) - F.length(F.translate(plain, str(v), ""))) * v for v in range(1, 10))
        return digits * F.coalesce(worth[F.right(run, F.lit(1))], F.lit(1))

    runs = F.regexp_extract_all(s, F.lit(f"{_DIGIT}+[{units}]?|[{units}]"), 0)
    total = F.aggregate(F.transform(runs, run_value), F.lit(0).cast("bigint"), lambda a, v: a + v)
    first_unit = F.coalesce(worth[F.regexp_extract(s, f"([{units}])", 1)], F.lit(0))
    return (F.when(s.isNull() | (s == ""), None)
             .when(lead != "", lead.cast("bigint"))
             .when(~s.rlike(f"^(?:{_NUMBER})$"), None)
             .when(total < first_unit, total + first_unit)
             .otherwise(total))


def cn_year(x, as_of) -> Column:
    """Year digits (Chinese digits mapped); two digits -> the as-of
    century."""
    mapped = F.translate(_c(x), CN_DIGITS, "0123456789")
    d = F.regexp_extract(mapped, r"^(\d+)", 1)
    century = F.floor(F.year(_c(as_of)) / 100) * 100
    return (F.when(d == "", None).when(F.length(d) == 2, century + d.cast("int")).otherwise(d.cast("int")))


def valid_time_word(x) -> Column:
    """Digits-only words of at most 6 characters are not dates (NULL);
    digits after 号/日 are cut."""
    s = _c(x)
    cut = F.regexp_replace(s, r"[号日]\d+$", "日")
    return F.when(s.rlike(r"^\d+$") & (F.length(s) <= 6), None).otherwise(cut)


_MONTH = "(?:" + "|".join(MONTH_NAMES) + r")\b\.?"
_ORDINAL = r"(\d{1,2})(?:st|nd|rd|th)?"
_DAY_MONTH = rf"(?<![\d:.]){_ORDINAL}[\s-]*(?:of\s+)?({_MONTH})(?:[\s,-]*(\d{{4}}|(?<=-)\d{{2}}|'\d{{2}})(?![\d:]))?"
_MONTH_DAY = rf"\b({_MONTH})[\s-]*{_ORDINAL}(?![\d:])(?:\s*,\s*|\s+|-)?(\d{{4}}(?![\d:]))?"
_MONTH_ONLY = rf"\b({_MONTH})(?:[\s,-]*(\d{{4}})(?![\d:]))?"
_WEEKDAY = r"\b(" + "|".join(WEEKDAY_NAMES) + r")\b"
_YEAR_FIRST = r"(?<!\d)(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?!\d)"
_COMPACT = r"(?<!\d)(\d{4})(\d{2})(\d{2})(?:t?(\d{2})(\d{2})(\d{2}))?(?!\d)"
_YEAR_LAST = r"(?<![\d/.-])(\d{1,2})([-/.])(\d{1,2})\2(\d{4}|\d{2})(?![\d/])"
_NO_YEAR = r"(?<![\d/])(\d{1,2})/(\d{1,2})(?![\d/])"
_CLOCK = r"(?<![\d:])(\d{1,2}):(\d{2})(?!\d)(?::(\d{2})(?:[.,]\d+)?)?(?:\s*([ap])\.?m\b)?"
_HOUR_ONLY = r"(?<![\d:])(\d{1,2})\s*([ap])\.?m\b"


def _let(value: Column, body) -> Column:
    """``body`` of a value that is computed once (a fold over one item keeps
    the expression as small as its parts; nested plain columns would be
    copied into every place that uses them)."""
    return F.element_at(F.transform(F.array(value), body), 1)


def general_datetime(x, as_of) -> Column:
    """X21, general part: the first date and the first clock time found
    anywhere in a text of Latin letters and digits. Dates: ``2021-03-05`` (with
    ``/`` or ``.`` too), ``20210305`` (also with ``T070809``), ``3/5/2021``,
    ``3/5``, ``5 March 2021``, ``5-Mar-21``, ``March 5th, 2021``, ``March
    2021``, weekdays (the next one, ``as_of`` included). Of two numbers the
    month comes first unless it is above 12. Two-digit years are those
    nearest to ``as_of``. Clock: ``15:07``, ``3:07:09.5 pm`` (fractions are
    cut), ``3pm``. Missing date parts come from ``as_of`` (its day at most
    the month's last), missing time parts are 0; an offset from UTC is passed
    over. NULL without date and clock, and where a part is out of range."""
    groups = {"iso": (_YEAR_FIRST, 1, 3, 4), "dm": (_DAY_MONTH, 1, 2, 3), "md": (_MONTH_DAY, 1, 2, 3), "mo": (_MONTH_ONLY, 1, 2),
              "last": (_YEAR_LAST, 1, 3, 4), "tight": (_COMPACT, 1, 2, 3, 4, 5, 6), "short": (_NO_YEAR, 1, 2), "week": (_WEEKDAY, 1),
              "clock": (_CLOCK, 1, 2, 3, 4), "hour": (_HOUR_ONLY, 1, 2)}
    months = F.create_map(*[F.lit(v) for k, n in enumerate(MONTH_NAMES, 1) for v in (n[:3], k)])
    weekdays = F.create_map(*[F.lit(v) for k, n in enumerate(WEEKDAY_NAMES) for v in (n[:3], k)])

    def texts(t):
        """Every group of every pattern, each found once."""
        found = [F.nullif(F.regexp_extract(t["s"], pattern, g), F.lit("")).alias(f"{name}{k}") for name, (pattern, *gs) in groups.items() for k, g in enumerate(gs)]
        return F.struct(t["ref"].alias("ref"), *found)

    def number(c):
        return c.cast("int")

    def full_year(c, ref):
        digits = F.replace(c, F.lit("'"), F.lit(""))
        near = F.floor(F.year(ref) / 100) * 100 + digits.cast("int")
        near = F.when(near >= F.year(ref) + 50, near - 100).when(near < F.year(ref) - 50, near + 100).otherwise(near)
        return F.when(c.isNull(), F.year(ref)).when(F.length(digits) == 2, near).otherwise(digits.cast("int")).cast("int")

    def named(p, year, month, day):
        return F.struct(full_year(year, p["ref"]).alias("y"), months[F.left(month, F.lit(3))].alias("m"), day.alias("d"))

    def numbers(year, first, second):
        """Of two numbers the month comes first unless it is above 12."""
        a, b = number(first), number(second)
        swap = (a > 12) & (b <= 12)
        return F.struct(year.alias("y"), F.when(swap, b).otherwise(a).alias("m"), F.when(swap, a).otherwise(b).alias("d"))

    def read(p):
        ref = p["ref"]
        ahead = F.date_add(F.to_date(ref), F.pmod(weekdays[F.left(p["week0"], F.lit(3))] - F.weekday(ref), F.lit(7)).cast("int"))
        date = F.coalesce(
            F.when(p["iso0"].isNotNull(), numbers(number(p["iso0"]), p["iso1"], p["iso2"])),
            F.when(p["dm0"].isNotNull(), named(p, p["dm2"], p["dm1"], number(p["dm0"]))),
            F.when(p["md0"].isNotNull(), named(p, p["md2"], p["md0"], number(p["md1"]))),
            F.when(p["last0"].isNotNull(), numbers(full_year(p["last2"], ref), p["last0"], p["last1"])),
            F.when(p["tight0"].isNotNull(), numbers(number(p["tight0"]), p["tight1"], p["tight2"])),
            F.when(p["mo0"].isNotNull(), named(p, p["mo1"], p["mo0"], F.lit(None).cast("int"))),
            F.when(p["short0"].isNotNull(), numbers(F.year(ref), p["short0"], p["short1"])),
            F.when(p["week0"].isNotNull(), F.struct(F.year(ahead).alias("y"), F.month(ahead).alias("m"), F.dayofmonth(ahead).alias("d"))))
        raw = F.coalesce(number(p["clock0"]), number(p["tight3"]), number(p["hour0"]), F.lit(0))
        half = F.when(p["clock0"].isNotNull(), p["clock3"]).when(p["tight3"].isNotNull(), None).otherwise(p["hour1"])
        hour = F.when(half.isNull(), raw).when(~raw.between(1, 12), None).when(half == "p", raw % 12 + 12).otherwise(raw % 12)
        minute = F.when(p["clock0"].isNotNull(), number(p["clock1"])).otherwise(F.coalesce(number(p["tight4"]), F.lit(0)))
        second = F.when(p["clock0"].isNotNull(), F.coalesce(number(p["clock2"]), F.lit(0))).otherwise(F.coalesce(number(p["tight5"]), F.lit(0)))
        some = date.isNotNull() | p["clock0"].isNotNull() | p["hour0"].isNotNull()
        return F.struct(ref.alias("ref"), some.alias("some"), date.alias("date"), hour.alias("h"), minute.alias("mi"), second.alias("s"))

    def built(r):
        ref = r["ref"]
        y, m = F.coalesce(r["date"]["y"], F.year(ref)), F.coalesce(r["date"]["m"], F.month(ref))
        last = F.dayofmonth(F.last_day(F.try_make_timestamp(y, m, F.lit(1), F.lit(0), F.lit(0), F.lit(0)).cast("date")))
        return F.when(r["some"], F.try_make_timestamp(y, m, F.coalesce(r["date"]["d"], F.least(F.dayofmonth(ref), last)), r["h"], r["mi"], r["s"]))

    text = F.struct(F.lower(_c(x)).alias("s"), _c(as_of).cast("timestamp").alias("ref"))
    return _let(_let(_let(text, texts), read), built)


def parse_cn_datetime(x, as_of) -> Column:
    """The general layouts first, then (texts without those marks)
    :func:`general_datetime`, else the parts marked 年 月 日/号
    点/时 分 秒, each looked up by its own mark; a bare number after the hour
    is the minute. Missing date parts come from ``as_of``, time parts are 0;
    下午/晚上/中午 add 12 h to an hour below 12. NULL without any part."""
    s, ref = _c(x), _c(as_of).cast("timestamp")
    general = F.coalesce(*[F.try_to_timestamp(s, F.lit(f)) for f in LAYOUTS], F.when(~s.rlike(r"\p{IsHan}"), general_datetime(s, ref)))

    def marked(pattern):
        text = F.regexp_extract(s, pattern, 1)
        return F.when(text != "", text)
    year, month, day, hour, second = (marked(f"({_NUMBER}){m}") for m in ("年", "月", "[号日]", _HOUR_MARK, "秒"))
    minute = F.coalesce(marked(f"({_NUMBER})分"), marked(f"{_HOUR_MARK}({_NUMBER})"))
    second = F.coalesce(second, marked(f"{_HOUR_MARK}{_NUMBER}{_HOUR_MARK}({_NUMBER})"))
    h = F.coalesce(cn_number(hour), F.lit(0))
    late = F.lit(False)
    for w in PM_WORDS:
        late = late | F.contains(s, F.lit(w))
    built = F.try_make_timestamp(
        F.coalesce(cn_year(year, ref), F.year(ref)), F.coalesce(cn_number(month), F.month(ref)), F.coalesce(cn_number(day), F.dayofmonth(ref)),
        F.when(late & (h < 12), h + 12).otherwise(h), F.coalesce(cn_number(minute), F.lit(0)), F.coalesce(cn_number(second), F.lit(0)))
    return F.coalesce(general, F.when(F.coalesce(year, month, day, hour, minute, second).isNotNull(), built))


def relative_day_mentions(text, as_of) -> Column:
    """X19 (re-aimed): relative day words -> ``as_of`` + n days, as dates."""
    t = _c(text)
    ref = F.to_date(_c(as_of))
    return F.filter(F.array(*[F.when(F.instr(t, F.lit(w)) > 0, F.date_add(ref, n))
                              for w, n in RELATIVE_DAYS.items()]), lambda d: d.isNotNull())


def date_mentions(text) -> Column:
    """Candidate date strings of a text, in order."""
    return F.regexp_extract_all(_c(text), F.lit(MENTION), 0)


def mentioned_times(text, as_of) -> Column:
    """The timestamps a text mentions, in order: candidates, validity
    filter, parsing; a relative day word moves the day that the rest of its
    mention is read against (alone it is that day at 0:00)."""
    ref = _c(as_of).cast("timestamp")

    def read(m):
        word = F.regexp_extract(m, f"^({_RELATIVE})", 1)
        moved = F.when(word == "", ref)
        for w, n in RELATIVE_DAYS.items():
            moved = F.when(word == w, F.date_add(F.to_date(ref), n).cast("timestamp")).otherwise(moved)
        rest = F.regexp_replace(m, f"^(?:{_RELATIVE})", "")
        return F.when(rest == "", moved).otherwise(parse_cn_datetime(valid_time_word(rest), moved))
    return F.filter(F.transform(date_mentions(text), read), lambda t: t.isNotNull())
