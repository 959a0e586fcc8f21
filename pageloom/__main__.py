"""Command lines: ``python -m pageloom normalize | plan | job``."""

from __future__ import annotations

import argparse
import json
import sys

from pyspark.sql import DataFrame, SparkSession

from pageloom.plans import jobs, normalize, summarize
from pageloom.session import build_session
from pageloom.sources import markdown as src

#: Rows that a listing shows.
SHOWN = 20


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="pageloom", description=__doc__)
    parser.add_argument("--master", help="Spark master; left to spark-submit by default")
    commands = parser.add_subparsers(dest="command", required=True)
    clean = commands.add_parser("normalize", help="clean text files into Markdown")
    clean.add_argument("paths", nargs="+")
    clean.add_argument("--output", required=True, help="a new folder")
    for name, text in (("plan", "what a summary of text files would take"), ("job", "a summary job in a folder")):
        sub = commands.add_parser(name, help=text)
        if name == "job":
            sub.add_argument("action", choices=("init", "review-map", "build-chapters", "build-final", "build-verify", "assemble", "status", "next", "audit", "cleanup"))
            sub.add_argument("root")
            sub.add_argument("--contract", help="a text file that stands before every prompt")
            sub.add_argument("--archive", help="where a copy of the job goes before it is cleaned up")
        sub.add_argument("paths", nargs="+" if name == "plan" else "*")
        sub.add_argument("--profile", default="compromise")
        sub.add_argument("--target", type=int)
        sub.add_argument("--most", type=int)
        sub.add_argument("--no-verify", dest="verify", action="store_const", const=False)
    return parser


def _show(rows: DataFrame, order: str) -> None:
    for line in rows.orderBy(order).limit(SHOWN).toJSON().collect():
        print(line)


def _job(spark: SparkSession, a: argparse.Namespace) -> None:
    job = jobs.Job(spark, a.root)
    if a.action == "init":
        contract = src.read_contract(spark, a.contract) if a.contract else ""
        job.init(src.read_documents(spark, a.paths), jobs.config_of(a.profile, target=a.target, most=a.most, verify=a.verify), contract)
    elif a.action.startswith("build-"):
        job.build({"chapters": "chapter"}.get(stage := a.action.removeprefix("build-"), stage))
    elif a.action == "review-map":
        _show(job.review(), "item")
    elif a.action == "assemble":
        _show(job.assemble().select("doc_id"), "doc_id")
    elif a.action == "audit":
        for rows, order in zip(job.audit(), ("warning", "doc_id"), strict=True):
            _show(rows, order)
    elif a.action == "cleanup":
        if a.archive:
            job.archive(a.archive)
        print(json.dumps(job.cleanup()))
    else:
        rows = job.status()
        _show(rows if a.action == "status" else rows.select("job", "stage", "action_type", "target"), "job")


def main(arguments: list[str] | None = None, spark: SparkSession | None = None) -> None:
    a = _parser().parse_args(arguments)
    spark = spark or build_session("pageloom", master=a.master)
    if a.command == "normalize":
        docs = src.read_documents(spark, a.paths)
        src.write_documents(normalize.normalize(docs), f"{a.output}/documents")
        src.write_json_lines(normalize.file_summary(docs), f"{a.output}/summary", "doc_id")
        _show(spark.read.json(f"{a.output}/summary"), "doc_id")
    elif a.command == "plan":
        _show(summarize.plan(src.read_documents(spark, a.paths), jobs.config_of(a.profile, target=a.target, most=a.most, verify=a.verify)), "doc_id")
    else:
        _job(spark, a)


if __name__ == "__main__":
    main(sys.argv[1:])
