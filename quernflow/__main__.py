"""``python -m quernflow JOB STORE [--name value ..]``: run a job, print its counts as JSON; 1 and a message on an error."""

from __future__ import annotations

import argparse
import json
import shlex
import sys

from quernflow.plans import jobs
from quernflow.session import local_session

JOBS = {"classify": jobs.classify, "build-pool": jobs.build_pool, "prepare": jobs.prepare, "build-groups": jobs.build_groups, "build-instantiations": jobs.build_instantiations, "feedback": jobs.run_feedback, "report": jobs.report, "verify": jobs.verify}
JOBS |= {"rebuild": jobs.rebuild, "prepare-inputs": jobs.prepare_inputs, "write-programs": jobs.write_programs, "build-corpus": jobs.build_corpus, "build-seeds": jobs.build_seeds}
JOBS |= {"evaluate": jobs.evaluate_programs, "collect-coverage": jobs.collect_coverage, "verify-archive": lambda store, scope=None: jobs.verify_archive(store.spark, store.root, scope)}


def main(args: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="quernflow")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("store")
    parser.add_argument("--groups", type=int, dest="count")
    parser.add_argument("--seed", type=int)
    parser.add_argument("--profile")
    parser.add_argument("--append", action="store_const", const=True)
    parser.add_argument("--native", action="store_const", const=True)
    parser.add_argument("--path")
    parser.add_argument("--min-ready-ratio", type=float, dest="least_ready_ratio")
    parser.add_argument("--out", dest="root", help="folder for files")
    parser.add_argument("--programs", help="folder that write-programs wrote to")
    parser.add_argument("--language")
    parser.add_argument("--state", help="folder that keeps the results of runs")
    parser.add_argument("--command", type=shlex.split, help="what runs a program and maps its edges")
    parser.add_argument("--timeout-ms", type=int, dest="timeout_ms")
    parser.add_argument("--min-edges", type=int, dest="least_edges")
    parser.add_argument("--optimization")
    parser.add_argument("--pattern", help="coverage files")
    parser.add_argument("--source-root", dest="source_root")
    parser.add_argument("--scope")
    given = vars(parser.parse_args(args))
    job, root = JOBS[given.pop("job")], given.pop("store")
    try:
        found = job(jobs.Store(local_session(), root), **{k: v for k, v in given.items() if v is not None})
    except Exception as error:  # noqa: BLE001  the command line reports any failure in one line
        print(f"error: {error}", file=sys.stderr)
        return 1
    print(json.dumps(found, ensure_ascii=False, sort_keys=True, default=str))
    return 0


if __name__ == "__main__":
    sys.exit(main())
