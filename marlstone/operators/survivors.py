"""Scores, and which of the rows of one work and episode survive."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Points by factor and value (fixed values); what isn't listed has none.
WEIGHTS: Mapping[str, Mapping[str, int]] = {
    "codec": {"h264": 40, "hevc": 25, "vp9": 0, "av1": -20, "vc1": -20, "mpeg2": -30, "xvid": -30},
    "container": {"mp4": 15, "mkv": 10, "m4v": 5, "webm": 0, "ts": -20, "m2ts": -20, "avi": -25, "mpg": -25, "mpeg": -25, "wmv": -40, "flv": -40, "rmvb": -50, "iso": -100},
    "source": {"bluray": 12, "web-dl": 12, "remux": 8, "webrip": 8, "hdtv": 2, "hdrip": 0, "dvd": -8, "dvdrip": -8, "vhs": -30, "screener": -50, "telecine": -70, "telesync": -80, "cam": -90},
    "quality": {"1080p": 15, "720p": 8, "2160p": 6, "576p": -2, "480p": -6, "360p": -15},
    "audio_codec": {"aac": 8, "ac3": 6, "eac3": 6, "opus": 3, "mp3": 0, "atmos": 0, "flac": -5, "dts": -8, "truehd": -10, "pcm": -10},
    "hdr": {"sdr": 0, "hlg": -5, "hdr10": -8, "hdr": -8, "hdr10+": -10, "dv": -25},
}
GIB, MIB = 1024**3, 1024**2


def points(factor: str, value: Column, weights: Mapping[str, Mapping[str, int]] = WEIGHTS) -> Column:
    """Points of a label by a map literal."""
    table = F.create_map(*[F.lit(x) for pair in weights[factor].items() for x in pair])
    return F.coalesce(table[value], F.lit(0))


def score(labels: Mapping[str, Column], popularity: Column, size: Column, *, bit_depth: Column, flags: Column, dual: Column, weight: float = 20.0, weights: Mapping[str, Mapping[str, int]] = WEIGHTS) -> Column:
    """log2(1 + popularity) * weight plus the points of the labels and some extras, to 9 decimals so that ties are ties everywhere."""
    total = F.log2(1 + F.greatest(F.coalesce(popularity, F.lit(0)), F.lit(0))) * weight
    for factor, value in labels.items():
        total = total + points(factor, value, weights)
    size, is_hevc = F.coalesce(size, F.lit(0)), F.coalesce(labels["codec"] == "hevc", F.lit(False))
    extras = (
        F.when((bit_depth == 10) & ~is_hevc, -5).otherwise(0)
        + F.when(F.array_contains(flags, "repack") | F.array_contains(flags, "proper"), 2).otherwise(0)
        + F.when(dual, 4).otherwise(0)
        + F.when(size > 30 * GIB, -10).otherwise(0)
        + F.when((size > 0) & (size < 300 * MIB) & (labels["quality"] == "1080p"), -10).otherwise(0)
    )
    return F.round(total + extras, 9)


def mark_survivors(rows: DataFrame, *, group: list[str], key: str = "id", score_col: str = "score", popularity: str = "seeders", freshness: str = "updated_at", size: str = "size_bytes", language: str = "lang", spanish_audio: str = "spanish_audio", english_audio: str = "english_audio", episode: str | None = None, other_policy: str = "delete", unknown_as: str = "english", margin: float = 10.0) -> DataFrame:
    """``rows`` with ``keep``.

    In each group the best row of Spanish and the best of English stay, and those that the options leave alone; if that is none, the best of all. Better is a
    higher score, then more popular, fresher, larger, and the smaller key. If a language's best has it only in subtitles, the first row with it as audio
    within ``margin`` points takes its place. Groups of one stay, as do groups whose ``episode`` is full, where nothing says that the rows are the same part.

    All that decides are least values by group, combined before the shuffle, so a group of any size is a row for each task; the winners then join the rows, where adaptive
    execution can split a hot group. Null group values are a group.
    """
    lang = lambda n: F.coalesce(F.col(f"{language}.{n}"), F.lit(False))
    es = lang("spanish") | (lang("unknown") & F.lit(unknown_as == "spanish"))
    en = lang("english") | (lang("unknown") & F.lit(unknown_as == "english"))
    alone = (lang("unknown") & F.lit(unknown_as not in ("english", "spanish"))) | (lang("other") & F.lit(other_policy == "keep"))
    minus = lambda c: -F.coalesce(c, F.lit(0))
    # the least place is the best row; a row without a score comes last
    place = F.struct(
        F.col(score_col).isNull().alias("unscored"), (-F.col(score_col)).alias("score"), minus(F.col(popularity)).alias("popularity"), minus(F.unix_millis(F.col(freshness).cast("timestamp"))).alias("freshness"),
        minus(F.col(size)).alias("size"), F.col(key).alias("key"),
    )
    classes = {"es": (es, spanish_audio), "en": (en, english_audio)}
    best = [F.count("*").alias("_n"), F.min(place).alias("_all"), F.max(alone).alias("_alone")]
    for name, (member, audio) in classes.items():
        dubbed = F.coalesce(F.col(audio), F.lit(False))
        best += [F.min(F.when(member, F.struct(place.alias("place"), dubbed.alias("dubbed")))).alias(f"_{name}"), F.min(F.when(member & dubbed, place)).alias(f"_{name}_dubbed")]
    groups = rows.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(group)]).agg(*best)

    def winner(name: str) -> Column:
        top, dubbed = F.col(f"_{name}"), F.col(f"_{name}_dubbed")
        near = dubbed.isNotNull() & ~top["dubbed"] & (dubbed["score"] - top["place"]["score"] <= margin)
        return F.when(near, dubbed["key"]).otherwise(top["place"]["key"])

    groups = groups.select(*[f"_g{i}" for i in range(len(group))], "_n", "_alone", F.col("_all.key").alias("_first"), *[winner(name).alias(f"_{name}_wins") for name in classes], (F.col("_es").isNull() & F.col("_en").isNull() & ~F.col("_alone")).alias("_none"))
    same = [rows[g].eqNullSafe(F.col(f"_g{i}")) for i, g in enumerate(group)]
    joined = rows.join(groups, _all(same))
    full = (F.col(episode) == "full") if episode else F.lit(False)
    mine = lambda c: F.coalesce(F.col(key) == F.col(c), F.lit(False))
    keep = (F.col("_n") == 1) | F.coalesce(full, F.lit(False)) | mine("_es_wins") | mine("_en_wins") | alone | (F.col("_none") & mine("_first"))
    return joined.withColumn("keep", keep).select(*[rows[c] for c in rows.columns], "keep")


def _all(conditions: list[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions)


def delete_set(marked: DataFrame, key: str = "id") -> DataFrame:
    return marked.where(~F.col("keep")).select(key).distinct()


def dedupe_metrics(marked: DataFrame, group: list[str], episode: str) -> DataFrame:
    """One row: groups, groups with duplicates, skipped groups of unknown episode, planned deletes."""
    per = marked.groupBy(*group).agg(F.count("*").alias("n"), F.max(F.col(episode) == "full").alias("full"), F.count_if(~F.col("keep")).alias("gone"))
    return per.agg(F.count("*").alias("n_groups"), F.count_if(F.col("n") > 1).alias("n_duplicated"), F.count_if((F.col("n") > 1) & F.col("full")).alias("n_unknown_episode"), F.coalesce(F.sum("gone"), F.lit(0)).alias("n_deletes"))
