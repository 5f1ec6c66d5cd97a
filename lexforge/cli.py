"""Commands over a dataset directory: run, enrich, translate, status, validate, export, repair-pdf, ingest.

--source names a factory `module:function(spark) -> CatalogueSource`, --model one `module:function() -> (tokenize,
translate)`; neither models nor endpoints are shipped."""

from __future__ import annotations

import argparse
import importlib
import sys
from dataclasses import replace

from .operators import repair, store as S, validate as V
from .session import build_session


def factory(name: str):
    """The function that 'module:function' names."""
    module, _, function = name.partition(":")
    return getattr(importlib.import_module(module), function)


def main(argv: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(prog="lexforge", description=__doc__)
    sub = p.add_subparsers(dest="command", required=True)
    for name in ("run", "enrich", "translate", "status", "validate", "export", "repair-pdf", "ingest"):
        s = sub.add_parser(name)
        s.add_argument("dataset")
        if name == "export":
            s.add_argument("out")
            s.add_argument("--formats", default="parquet")
        if name == "repair-pdf":
            s.add_argument("audit")
            s.add_argument("--apply", action="store_true", help="without it only the audit is written")
        if name in ("run", "enrich"):
            s.add_argument("--source", required=True)
        if name == "enrich":
            s.add_argument("--categories", default=",".join(S.CATEGORIES))
            s.add_argument("--force", action="store_true")
        if name == "translate":
            s.add_argument("--model", required=True)
            s.add_argument("--max-chars", type=int, default=100_000)
        if name in ("run", "ingest"):
            s.add_argument("config")
            s.add_argument("--fresh", action="store_true")
        if name == "run":
            s.add_argument("--limit", type=int)
            s.add_argument("--retry-failed", action="store_true")
        if name == "ingest":
            s.add_argument("landing")
            s.add_argument("checkpoint")
    a = p.parse_args(argv)
    if getattr(a, "fresh", False) and getattr(a, "limit", None) is not None:
        p.error("--fresh and --limit exclude each other")
    spark = build_session()
    data = S.Dataset(spark, a.dataset)
    if a.command == "status":
        cp = data.read("work_checkpoint")
        S.checkpoint_summary(cp).orderBy("status").show(truncate=False)
        S.failures(cp).orderBy("celex_id").show(50, truncate=False)
    elif a.command == "validate":
        report = V.validate({n: data.read(n) for n in S.SCHEMAS})
        report.orderBy("severity", "code").show(100, truncate=False)
        return int(V.has_errors(report))
    elif a.command == "export":
        S.export(data, a.out, a.formats.split(","))
    elif a.command == "repair-pdf":
        audit, works, cp = repair.pdf_repair(data.read("works"), data.read("text_units"), data.read("work_checkpoint"))
        S.write_audit(audit, a.audit)
        if a.apply:
            data.write("works", works)
            data.write("work_checkpoint", cp)
    elif a.command == "enrich":
        from .plans import pipeline

        source, categories = factory(a.source)(spark), tuple(a.categories.split(","))
        print(pipeline.enrich(data, lambda ids: source.enrichment(ids, categories), categories, a.force))
    elif a.command == "translate":
        from .plans import pipeline

        print(pipeline.translate(data, factory(a.model), a.max_chars))
    elif a.command == "run":
        from .plans import pipeline
        from .sources.config import load_config

        config = load_config(a.config)
        if a.limit is not None:
            config = replace(config, processing=replace(config.processing, limit=a.limit))
        if a.fresh or a.retry_failed:
            data.write("work_checkpoint", S.reset(data.read("work_checkpoint"), "all" if a.fresh else "failed"))
        status = pipeline.run(data, config, source=factory(a.source)(spark))
        print(status)
        return int(status != "complete")
    else:
        from .sources.config import load_config
        from .streaming import landing

        if a.fresh:
            data.write("work_checkpoint", S.reset(data.read("work_checkpoint")))
        landing.start(data, load_config(a.config), a.landing, a.checkpoint).awaitTermination()
    return 0


if __name__ == "__main__":
    sys.exit(main())
