"""The curation run: policies, normalisation, enrichment and deduplication of one catalogue table."""

from __future__ import annotations

import logging
import os
import time
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..config import Config
from ..functions.languages import ENGLISH, SPANISH, language_class, language_labels, union_ordered
from ..functions.labels import codec_label, quality_label, type_label
from ..functions.release import parsed
from ..operators import enrich, guard, identity, patch, policies, survivors
from ..sources.store import TableStore, delete_rows, with_telemetry
from ..sources.workspace import Workspace

log = logging.getLogger(__name__)


@dataclass
class StepResult:
    name: str
    seconds: float = 0.0
    error: str | None = None
    metrics: dict[str, int] = field(default_factory=dict)


@dataclass
class RunResult:
    steps: list[StepResult]
    table: DataFrame

    @property
    def ok(self) -> bool:
        return all(s.error is None for s in self.steps)

    def write_summary(self, path: str | None = None) -> bool:
        """Append the summary to a file; without a path to the one that a workflow names in GITHUB_STEP_SUMMARY. Whether there was one."""
        path = path or os.environ.get("GITHUB_STEP_SUMMARY")
        if not path:
            return False
        with open(path, "a", encoding="utf-8") as f:
            f.write(self.markdown() + "\n")
        return True

    def markdown(self) -> str:
        rows = "".join(f"| {s.name} | {s.seconds:.1f} s | {s.error or ', '.join(f'{k} {v}' for k, v in s.metrics.items())} |\n" for s in self.steps)
        return f"| step | time | result |\n|-|-|-|\n{rows}"


def _say(step: str, doomed: DataFrame, c: Config) -> None:
    """Log the titles of a few rows that a step deletes: the number is the feature."""
    if c.log_samples and log.isEnabledFor(logging.INFO):
        for r in doomed.select("id", "title").orderBy("id").limit(c.log_samples).collect():
            log.info("%s deletes %s: %.120s", step, r.id, r.title)


def adult_step(table: DataFrame, c: Config, ws: Workspace, extras: Mapping) -> tuple[DataFrame, dict]:
    doomed = policies.keyword_policy(F.col("title"), extra=c.extra_keywords)
    counts = guard.check(table, {"adult": (doomed, F.lit(True))}, c.max_delete_ratio, c.guard_min_rows)
    kept, gone = policies.split_by(table, doomed)
    _say("adult", gone, c)
    return kept, {"scanned": counts["adult"][1], "deleted": counts["adult"][0]}


def size_step(table: DataFrame, c: Config, ws: Workspace, extras: Mapping) -> tuple[DataFrame, dict]:
    """Rows without kind and too small for a film are parsed; others aren't."""
    small = F.col("type").isNull() & (F.col("size_bytes") < c.min_movie_bytes)
    p = parsed(F.when(small, F.col("title")), this_year=c.as_of.year)
    marked = table.withColumn("_p", p)
    sure = F.col("_p.clean_title") != ""
    doomed = policies.size_policy(F.col("type"), F.col("size_bytes"), movie=c.min_movie_bytes, series=c.min_series_bytes, anime=c.size_covers_anime, zero=c.size_includes_zero, parsed_kind=F.when(small & sure, F.col("_p.type")), parsed_confidence=F.col("_p.type_confidence"), confidence=c.type_confidence)
    saved = ws.save(marked.withColumn("_doomed", F.coalesce(doomed, F.lit(False))).drop("_p"), "size")
    d, kind = F.col("_doomed"), F.col("type")
    episodes = kind.isin("series", "anime") if c.size_covers_anime else kind == "series"
    rules = {"films": (d & (kind == "movie"), kind == "movie"), "episodes": (d & episodes, episodes), "untyped": (d & kind.isNull(), F.lit(True))}
    counts = guard.check(saved, rules, c.max_delete_ratio, c.guard_min_rows)
    _say("size", saved.where(d), c)
    return saved.where(~d).drop("_doomed"), {f"deleted_{k}": v[0] for k, v in counts.items()}


def dead_step(table: DataFrame, c: Config, ws: Workspace, extras: Mapping) -> tuple[DataFrame, dict]:
    doomed = policies.stale_policy(F.col("seeders"), F.col("updated_at"), as_of=c.as_of, days=c.stale_days, include_null=c.stale_includes_null)
    counts = guard.check(table, {"dead": (doomed, F.lit(True))}, c.max_delete_ratio, c.guard_min_rows)
    kept, gone = policies.split_by(table, doomed)
    _say("dead", gone, c)
    return kept, {"scanned": counts["dead"][1], "deleted": counts["dead"][0]}


def normalize_step(table: DataFrame, c: Config, ws: Workspace, extras: Mapping) -> tuple[DataFrame, dict]:
    marked = table.withColumn("_p", parsed(F.col("title"), this_year=c.as_of.year))
    made = ws.save(patch.normalisation_patch(marked, "_p", clean_title=c.clean_title_column, overwrite_type=c.overwrite_type, overwrite_episodes=c.overwrite_episodes, merge_languages=c.merge_title_languages, confidence=c.type_confidence), "patch")
    columns = [x for x in made.columns if x not in ("id", "changed")]
    good, bad = patch.split_valid(made, patch.constraint_columns(columns))
    counts = {r.column_name: r.n_changes for r in patch.histogram(good).collect()}  # a row for each column
    return patch.apply_patch(table, good, "id", columns), {"rejected": bad.count(), **dict(sorted(counts.items()))}


def enrich_step(table: DataFrame, c: Config, ws: Workspace, extras: Mapping) -> tuple[DataFrame, dict]:
    """extras: the catalogue tables search, bridge, find and external; without them ids are only propagated. A row whose title says no name is named by its stored name."""
    table = with_telemetry(table) if extras else table
    base = table.withColumn("_p", parsed(F.col("title"), this_year=c.as_of.year))
    if c.clean_title_column in table.columns:
        stored = F.when(F.col("_p.clean_title") == "", F.col(c.clean_title_column))
        base = base.withColumn("_q", parsed(stored, this_year=c.as_of.year))
        use = F.col("_p.clean_title") == ""
        base = base.withColumn("_p", F.col("_p").withField("clean_title", F.when(use, F.col("_q.clean_title")).otherwise(F.col("_p.clean_title"))).withField("search_key", F.when(use, F.col("_q.search_key")).otherwise(F.col("_p.search_key"))).withField("year", F.coalesce(F.col("_p.year"), F.col("_q.year")))).drop("_q")
    ids = {n: F.col(n) for n in enrich.ID_COLUMNS}
    kind = F.coalesce(type_label(F.col("type")), F.col("_p.type"))
    rows = base.select("id", *enrich.ID_COLUMNS, kind.alias("kind"), F.col("_p.search_key").alias("search_key"), F.col("_p.clean_title").alias("title"), F.col("_p.year").alias("year"), F.coalesce(F.col("season").cast("int"), F.col("_p.season")).alias("season"), F.col("type").isNull().alias("type_guessed"), F.coalesce(F.col("_p.season"), F.col("_p.episode"), *[F.col(n).cast("int") for n in ("season", "episode", "absolute_episode") if n in table.columns]).isNotNull().alias("has_episode"), policies.needed_ids(kind, ids, has_tmdb=c.has_tmdb, tmdb_for_anime=c.tmdb_for_anime).alias("needed"), *([F.col("ids_attempts")] if enrich.has_telemetry(table) else []))
    due = F.lit(True)
    if enrich.has_telemetry(table):
        rows = rows.join(table.select("id", "ids_checked_at"), "id")
        due = policies.recheck_due(F.col("ids_checked_at"), F.col("ids_attempts"), as_of=c.as_of, days=c.recheck_days, most=c.max_attempts)
    rows = ws.save(rows.where((F.size("needed") > 0) & due & (F.col("search_key") != "")), "orphans")
    groups = ws.save(enrich.still_needed(enrich.work_groups(rows, attempts="ids_attempts" if enrich.has_telemetry(table) else None, flags=("has_episode", "type_guessed"))), "works")
    resolved = None
    if extras:
        tasks = enrich.lookup_budget(groups, c.max_lookups).withColumn("title", F.col("search_key"))
        resolved = ws.save(enrich.resolve(tasks.select("work", "kind", "title", "year", "season", "has_episode", "type_guessed", *enrich.ID_COLUMNS), extras["search"], extras["bridge"], extras["find"], extras["external"], min_score=c.min_similarity), "resolved")
        groups = groups.drop(*enrich.ID_COLUMNS).join(resolved.select("work", *enrich.ID_COLUMNS), "work", "left").join(groups.select("work", *[F.col(i).alias(f"_o_{i}") for i in enrich.ID_COLUMNS]), "work").select("work", *[F.coalesce(i, f"_o_{i}").alias(i) for i in enrich.ID_COLUMNS])
    keys = enrich.work_key(F.col("kind"), F.col("search_key"), F.col("_y"), F.col("season"))
    same = rows.join(ws.spark.read.parquet(ws.path("works")).groupBy(F.col("kind").alias("_k"), F.col("search_key").alias("_t"), F.coalesce("season", F.lit(0)).alias("_s")).agg(F.min("year").alias("_low"), F.max("year").alias("_high")), (F.col("kind") == F.col("_k")) & (F.col("search_key") == F.col("_t")) & (F.when((F.col("kind") == "anime") & (F.col("season") > 1), F.col("season")).otherwise(0) == F.col("_s")))
    placed = same.withColumn("_y", F.when(F.col("_low").eqNullSafe(F.col("_high")), F.col("_low")).otherwise(F.col("year"))).withColumn("work", keys)
    filled = enrich.propagate(placed.select("id", "work", *enrich.ID_COLUMNS), groups).where(F.size("filled") > 0)
    filled = ws.save(filled.select("id", F.col("filled").alias("changed"), *enrich.ID_COLUMNS), "ids")
    good, bad = patch.split_valid(filled, patch.constraint_columns(enrich.ID_COLUMNS))
    out = patch.apply_patch(table, good, "id", list(enrich.ID_COLUMNS))
    if resolved is not None and not c.dry_run:
        tried = placed.select("id", "work").join(resolved.select("work", "ids_source", "ids_confidence"), "work").join(table.select("id", "ids_attempts"), "id")
        out = patch.apply_patch(out, enrich.telemetry_patch(tried, as_of=c.as_of), "id", list(enrich.TELEMETRY))
    return out, {"orphans": rows.count(), "updated": good.count(), "rejected": bad.count()}


def dedupe_step(table: DataFrame, c: Config, ws: Workspace, extras: Mapping) -> tuple[DataFrame, dict]:
    base = table.withColumn("_p", parsed(F.col("title"), this_year=c.as_of.year))
    p = lambda n: F.col(f"_p.{n}")
    kind = F.coalesce("type", p("type"))
    codec, quality = F.coalesce(codec_label(F.col("codec")), p("codec")), F.coalesce(quality_label(F.col("quality")), p("quality"))
    number = identity.whole_number
    labels = {"codec": codec, "container": p("container"), "source": p("source"), "quality": quality, "audio_codec": p("audio_codec"), "hdr": p("hdr")}
    audio, subtitles = union_ordered(language_labels(F.col("audio")), p("audio")), union_ordered(language_labels(F.col("subtitles")), p("subtitles"))
    ids = identity.work_identifiers(kind, F.col("imdb_id"), F.col("tmdb_id"), F.col("anilist_id"), F.col("kitsu_id"), F.col("mal_id"))
    rows = base.select(
        "id",
        ids.alias("ids"),
        identity.title_alias(kind, p("search_key"), p("year")).alias("alias"),
        identity.episode_key(kind, F.coalesce(number(F.col("season")), p("season")), F.coalesce(number(F.col("episode")), p("episode")), F.coalesce(number(F.col("absolute_episode")), p("absolute_episode")), episode_end=p("episode_end"), season_end=p("season_end"), complete=p("is_complete")).alias("episode_key"),
        survivors.score(labels, number(F.col("seeders")), number(F.col("size_bytes")), bit_depth=p("bit_depth"), flags=p("flags"), dual=p("dual"), weight=c.popularity_weight).alias("score"),
        number(F.col("seeders")).alias("seeders"),
        "updated_at",
        number(F.col("size_bytes")).alias("size_bytes"),
        audio.alias("_audio"),
        subtitles.alias("_subtitles"),
    )
    overlap = lambda c_, group: F.arrays_overlap(F.col(c_), F.array(*map(F.lit, group)))
    rows = ws.save(rows.select("*", language_class(F.col("_audio"), F.col("_subtitles")).alias("lang"), overlap("_audio", SPANISH).alias("spanish_audio"), overlap("_audio", ENGLISH).alias("english_audio")).drop("_audio", "_subtitles"), "entries")
    roots = identity.work_roots(rows, ws, alias="alias" if c.title_fallback else None)
    keyed = rows.join(roots, "id")
    marked = ws.save(survivors.mark_survivors(keyed, group=["root", "episode_key"], episode="episode_key", other_policy=c.other_language_policy, unknown_as=c.unknown_language_as, margin=c.audio_tie_margin), "marked")
    counts = guard.check(marked, {"dedupe": (~F.col("keep"), F.lit(True))}, c.max_delete_ratio, c.guard_min_rows)
    m = survivors.dedupe_metrics(marked, ["root", "episode_key"], "episode_key").first()
    _say("dedupe", table.join(survivors.delete_set(marked), "id", "left_semi"), c)
    return delete_rows(table, survivors.delete_set(marked)), {"keyed": counts["dedupe"][1], "groups": m.n_groups, "duplicated": m.n_duplicated, "unknown_episode": m.n_unknown_episode, "deleted": m.n_deletes}


STEPS: Mapping[str, Callable] = {"adult": adult_step, "size": size_step, "dead": dead_step, "normalize": normalize_step, "enrich": enrich_step, "dedupe": dedupe_step}


def curate(table: DataFrame, config: Config, extras: Mapping[str, DataFrame] | None = None) -> RunResult:
    """Run the chosen steps in their order. A step that fails changes nothing, and ends the run unless the settings say otherwise. Nothing is committed here."""
    if problems := config.problems():
        raise ValueError("; ".join(problems))
    done = []
    for name in config.steps:
        began, result = time.monotonic(), StepResult(name)
        ws = Workspace(table.sparkSession, f"curate-{name}")
        try:
            after, result.metrics = STEPS[name](table, config, ws, extras or {})
            table = ws.save(after, "out")
        except Exception as e:  # noqa: BLE001
            log.exception("step %s", name)
            result.error = f"{type(e).__name__}: {e}"
        result.seconds = time.monotonic() - began
        done.append(result)
        if result.error and not config.continue_on_error:
            break
    return RunResult(done, table)


def run(store: TableStore, config: Config, extras: Mapping[str, DataFrame] | None = None) -> RunResult:
    """Curate the store's current version and, unless it is a dry run or a step failed, commit the result as the next."""
    result = curate(store.read(), config, extras)
    if result.ok or config.continue_on_error:
        store.commit(result.table, sort="id", dry_run=config.dry_run)
    return result
