"""Row-level rules of the metrics, as column expressions."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from fairway.functions.numeric import ColumnOrName, _col

# Fixed values that must equal the source metric's definition:
# event ids treated as major championships
# (Masters, Masters second id, PGA Championship, U.S. Open, The Open).
MAJORS: tuple[int, ...] = (14, 536, 33, 26, 100)

# Score thresholds of the difficulty index.
HIGH_SCORE = 80   # a round counts as "high" when score >= 80
LOW_SCORE = 70    # a round counts as "low" when score < 70

# Wave labels and the hour that splits them.
MORNING, AFTERNOON, NOON_HOUR = "morning", "afternoon", 12

# The four player categories.
PROPER_PLAYER, IMPOSTER, GAMER, MULE = "Proper Player", "Imposter", "Gamer", "Mule"


def is_major(event_id: ColumnOrName = "event_id") -> Column:
    """True for a major championship; NULL ids are not majors."""
    return F.when(_col(event_id).isin(list(MAJORS)), F.lit(True)).otherwise(F.lit(False))


def wave(teetime: ColumnOrName = "teetime") -> Column:
    """Morning when the tee time is before noon, else afternoon (NULL too).
    Missing tee times are stored as midnight, so they land in the morning."""
    return F.when(F.hour(_col(teetime)) < NOON_HOUR, F.lit(MORNING)).otherwise(F.lit(AFTERNOON))


def category(ppi: ColumnOrName = "ppi", sg_total: ColumnOrName = "sg_total") -> Column:
    """Four-way split of index against strokes gained. NULL strokes gained
    falls through to the last class; a NaN index counts as the largest value."""
    p, sg = _col(ppi), _col(sg_total)
    return (
        F.when((sg >= 0) & (p > sg), F.lit(PROPER_PLAYER))
        .when((sg >= 0) & (p <= sg), F.lit(IMPOSTER))
        .when((sg < 0) & (p > sg), F.lit(GAMER))
        .otherwise(F.lit(MULE))
    )


def weighted_gain(wave_average: ColumnOrName = "wave_average", score: ColumnOrName = "score",
                  factor: ColumnOrName = "course_factor_star") -> Column:
    """Per-round contribution ``(wave average - score) * factor``."""
    return (_col(wave_average) - _col(score)) * _col(factor)


def whole_days_between(start: ColumnOrName, end: ColumnOrName) -> Column:
    """Whole elapsed 24-hour days from ``start`` to ``end`` (truncated), not a
    calendar-date difference: 23:00 -> 01:00 two years later is 730, not 731."""
    return F.timestamp_diff("DAY", _col(start), _col(end))


def _folding() -> tuple[str, str, dict[str, str]]:
    """Latin letters and their ASCII base, by Unicode decomposition; letters
    without one, or that become several, by the short list below."""
    # Letters that Unicode does not decompose.
    special = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ĳ": "ij"}
    single = {"ø": "o", "ł": "l", "đ": "d", "ð": "d", "ħ": "h", "ı": "i", "ŧ": "t", "ŋ": "n", "’": " "}
    for code in [*range(0xC0, 0x250), *range(0x1E00, 0x1F00)]:
        ch = chr(code)
        base = unicodedata.normalize("NFKD", ch)[0]
        if ch == ch.lower() and ch not in special and base.isascii() and base.isalnum():
            single.setdefault(ch, base)
    return "".join(single), "".join(single.values()), special


_ACCENTED, _PLAIN, _SPECIAL = _folding()


def slug(name: ColumnOrName) -> Column:
    """Lower-case ASCII slug: Latin letters lose their marks, commas inside
    numbers vanish, runs of other characters become one '-'."""
    folded = F.lower(_col(name))
    for letter, plain in _SPECIAL.items():
        folded = F.replace(folded, F.lit(letter), F.lit(plain))
    folded = F.translate(folded, _ACCENTED, _PLAIN)
    folded = F.regexp_replace(folded, "(?<=[0-9]),(?=[0-9])", "")
    dashed = F.regexp_replace(folded, "[^a-z0-9]+", "-")
    return F.regexp_replace(dashed, "^-+|-+$", "")
