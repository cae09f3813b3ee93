"""python -m marlstone parse TITLE... | doctor [TABLE] (settings come from the environment, a .env file beside it included)"""

from __future__ import annotations

import json
import os
import sys

from .config import Config, read_env_file


def main(args: list[str]) -> int:
    if args[:1] == ["parse"] and len(args) > 1:
        from .functions.release import parse

        for title in args[1:]:
            print(json.dumps(vars(parse(title)), ensure_ascii=False))
        return 0
    if args[:1] == ["doctor"] and len(args) <= 2:
        from .plans.doctor import examine
        from .sources.catalogues import Catalogues

        env = {**(read_env_file(open(".env", encoding="utf-8").read()) if os.path.exists(".env") else {}), **os.environ}
        store = None
        if len(args) == 2:
            from pyspark.sql import SparkSession

            from .sources.store import TableStore

            store = TableStore(SparkSession.builder.getOrCreate(), args[1])
        found = examine(Config.from_env(env), store, Catalogues.from_env(env))
        print(*found, sep="\n")
        return int(any(f.fatal and not f.ok for f in found))
    print(__doc__)
    return 2


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
