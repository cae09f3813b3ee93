"""Canonical labels of codecs, resolutions and categories as native columns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Spellings of codecs as whole values (fixed values).
CODECS = {
    "h264": ["x264", "x.264", "h264", "h.264", "avc", "avc1", "h264/avc", "mpeg4 avc", "mpeg-4 avc"],
    "hevc": ["x265", "x.265", "h265", "h.265", "hevc", "hvc1", "hev1", "h265/hevc"],
    "av1": ["av1", "av01"],
    "xvid": ["xvid", "divx", "mpeg4", "mpeg-4", "mpeg4 asp", "mpeg-4 asp", "mp4v"],
    "vp9": ["vp9", "vp09"],
    "vp8": ["vp8", "vp08"],
    "mpeg2": ["mpeg2", "mpeg-2", "mpeg2video", "mpg2"],
    "vc1": ["vc1", "vc-1", "wmv", "wmv3", "wvc1"],
}
#: Spellings inside a longer value, in the order in which they count; then those that must be a word there.
CODEC_PARTS = {
    "hevc": ["x265", "x.265", "h265", "h.265", "hevc"],
    "h264": ["x264", "x.264", "h264", "h.264", "avc"],
    "av1": [],
    "xvid": ["xvid", "divx"],
    "vp9": ["vp9"],
    "mpeg2": ["mpeg2", "mpeg-2"],
    "vc1": ["vc1", "vc-1"],
}
CODEC_WORDS = {"av1": ["av1"]}
#: Spellings of resolutions as whole values without blanks; numbers and words inside a longer one (fixed values, first match counts).
QUALITIES = {
    "2160p": ["2160", "2160p", "4k", "uhd", "8k", "4320", "4320p", "3840x2160"],
    "1080p": ["1080", "1080p", "1080i", "fhd", "fullhd", "1920x1080"],
    "720p": ["720", "720p", "hd", "hdready", "1280x720"],
    "576p": ["576", "576p", "pal"],
    "480p": ["480", "480p", "sd", "ntsc", "dvd"],
    "360p": ["360", "360p"],
}
QUALITY_NUMBERS = {"2160p": ["2160", "4320"], "1080p": ["1080"], "720p": ["720"], "576p": ["576"], "480p": ["480"], "360p": ["360"]}
QUALITY_WORDS = {"2160p": ["4k", "uhd", "8k"], "1080p": ["fhd", "fullhd"]}
#: Sources that stand where a resolution should.
NOT_QUALITIES = ["cam", "ts", "tc", "telesync", "hdcam", "hdts"]
#: Spellings of categories.
TYPES = {
    "movie": ("movie", "movies", "film", "pelicula", "película"),
    "series": ("series", "serie", "tv", "show", "tvshow", "tv show", "episode"),
    "anime": ("anime", "animes"),
}
#: Widths of columns.
WIDTHS = {"type": 10, "codec": 20, "quality": 20}


def _chain(pairs: list[tuple[Column, str | None]]) -> Column:
    out = None
    for test, label in pairs:
        out = F.when(test, label) if out is None else out.when(test, label)
    return out


def _any(tests: list[Column]) -> Column:
    return reduce(lambda a, b: a | b, tests)


def codec_label(c: Column) -> Column:
    """The whole value's label, else that of the first spelling inside it."""
    v = F.lower(F.trim(c))
    words = F.regexp_extract_all(v, F.lit("([a-z0-9_]+)"))
    inside = [(_any([*(v.contains(x) for x in parts), *(F.array_contains(words, x) for x in CODEC_WORDS.get(label, ()))]), label) for label, parts in CODEC_PARTS.items()]
    return _chain([*((v.isin(*names), label) for label, names in CODECS.items()), *inside])


def quality_label(c: Column) -> Column:
    """The whole value's label, else that of a number or a word in it."""
    v = F.regexp_replace(F.lower(c), r"\s+", "")
    numbers, words = F.regexp_extract_all(v, F.lit("([0-9]+)")), F.regexp_extract_all(v, F.lit("([a-z0-9]+)"))
    inside = [(_any([*(F.array_contains(numbers, x) for x in own), *(F.array_contains(words, x) for x in QUALITY_WORDS.get(label, ()))]), label) for label, own in QUALITY_NUMBERS.items()]
    return _chain([*((v.isin(*names), label) for label, names in QUALITIES.items()), (v.isin(*NOT_QUALITIES), None), *inside])


def type_label(c: Column) -> Column:
    v = F.lower(F.trim(c))
    return _chain([(v.isin(*names), label) for label, names in TYPES.items()])


def pick_quality(stored: Column, parsed: Column) -> Column:
    """A vague HD or SD gives way to the title's resolution; an explicit stored value wins."""
    vague = F.lower(F.trim(stored)).isin("hd", "sd")
    return F.when(vague & parsed.isNotNull(), parsed).otherwise(F.coalesce(quality_label(stored), parsed))


def fit(column: str, c: Column) -> Column:
    """``c`` cut to the width of its column."""
    return F.substring(c, 1, WIDTHS[column]) if column in WIDTHS else c
