"""What would keep a run from starting, found without writing anything."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql.types import StructType

from ..config import Config
from ..operators.enrich import ID_COLUMNS, has_telemetry
from ..sources.catalogues import Catalogues
from ..sources.store import TableStore

#: Columns that each step reads.
NEEDED = {
    "adult": ("id", "title"),
    "size": ("id", "title", "type", "size_bytes"),
    "dead": ("id", "seeders", "updated_at"),
    "normalize": ("id", "title", "type", "season", "episode", "absolute_episode", "codec", "quality", "audio", "subtitles"),
    "enrich": ("id", "title", "type", "season", *ID_COLUMNS),
    "dedupe": ("id", "title", "type", "seeders", "size_bytes", "updated_at", "audio", "subtitles", *ID_COLUMNS),
}


@dataclass(frozen=True)
class Finding:
    name: str
    ok: bool
    detail: str
    fatal: bool = True

    def __str__(self) -> str:
        return f"{'ok' if self.ok else 'FAILS' if self.fatal else 'note'}  {self.name}: {self.detail}"


def masked(secret: str | None) -> str:
    """Enough of a secret to know it by."""
    return "not set" if not secret else f"{secret[:3]}... ({len(secret)} characters)" if len(secret) > 8 else f"set ({len(secret)} characters)"


def missing_columns(schema: StructType, steps: tuple[str, ...]) -> dict[str, list[str]]:
    there = set(schema.names)
    return {s: lacks for s in steps if (lacks := sorted(set(NEEDED[s]) - there))}


def examine(config: Config, store: TableStore | None = None, catalogues: Catalogues | None = None) -> list[Finding]:
    """The settings, the table with the columns that the chosen steps read, and the credentials, each examined whatever the others say."""
    found = [Finding("settings", not (problems := config.problems()), "; ".join(problems) or f"steps {', '.join(config.steps)}{', dry run' if config.dry_run else ''}")]

    def tried(name: str, look: Callable[[], Finding]) -> None:
        try:
            found.append(look())
        except Exception as e:  # noqa: BLE001  a diagnosis goes on
            found.append(Finding(name, False, f"{type(e).__name__}: {str(e).splitlines()[0] if str(e) else ''}"))

    if store is not None:

        def table() -> Finding:
            df = store.read()
            lacks = missing_columns(df.schema, config.steps)
            return Finding("table", not lacks, "; ".join(f"{s} lacks {', '.join(c)}" for s, c in lacks.items()) or f"version {store.version()}, {store.estimated_count()} rows")

        tried("table", table)
        if "enrich" in config.steps:
            tried("telemetry", lambda: Finding("telemetry", (there := has_telemetry(store.read())), "attempts are kept" if there else "its columns are added by the first run with catalogues", fatal=False))
    if catalogues is not None:
        if catalogues.tmdb is None:
            found.append(Finding("TMDB key", False, "not set: films and series get no ids by title", fatal=False))
        else:
            tried("TMDB key", lambda: Finding("TMDB key", bool(catalogues.check_key()), masked(catalogues.key)))
    return found
