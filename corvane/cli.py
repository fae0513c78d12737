"""Command line: extract, enrich, load, index, stats, search, advanced, prompt.

    python -m corvane.cli full DATA --store FOLDER
    python -m corvane.cli search "tasa de interés 2022" --store FOLDER -k 5
"""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from corvane.functions.taxonomy import BASIC_DOMAIN, DOMAIN, from_json
from corvane.operators import embed, enrich, stats
from corvane.operators.filters import AdvancedFilters
from corvane.plans import prompt, search
from corvane.plans.parse import month_numbers
from corvane.plans.profiles import BASIC, FULL
from corvane.sources import files
from corvane.sources.indexes import Indexes
from corvane.sources.reports import Reports
from corvane.sources.store import Store, read_chunks_json, read_documents_json, write_json

HASHED = "hashed"
PIECES = "chunk_id string, document_id string, text string, char_count int, token_estimate int, page_start int, page_end int, position_in_doc int, section_title_raw string, chunk_date string, total_in_doc int"


def _loader(model: str, dimension: int) -> embed.Loader:
    return embed.hashed_words(dimension) if model == HASHED else embed.sentence_model(model)


def _parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    top.add_argument("--store", default="corvane-store", help="folder of the tables")
    top.add_argument("--prefix", default="", help="prefix of the tables' names")
    top.add_argument("--work", default="logs", help="folder of the stages' JSON")
    top.add_argument("--model", default=os.environ.get("RAG_EMBEDDING_MODEL", HASHED))
    top.add_argument("--dimension", type=int, default=64)
    top.add_argument("--profile", choices=("full", "basic"), default="full")
    top.add_argument("--taxonomy", help="JSON file of keyword rows, or of {variable: [keywords]}; without it no variables are found")
    some = top.add_subparsers(dest="do", required=True)
    for name in ("extract", "full"):
        some.add_parser(name).add_argument("data")
    for name in ("enrich", "load", "index", "stats"):
        some.add_parser(name)
    some.add_parser("setup").add_argument("--drop", action="store_true")
    for name in ("search", "prompt"):
        p = some.add_parser(name)
        p.add_argument("query")
        p.add_argument("-k", type=int, default=5)
        p.add_argument("--no-mmr", action="store_true")
        p.add_argument("--json", action="store_true")
        p.add_argument("--system")
        p.add_argument("--indexed", action="store_true", help="recall through the indexes that `index` makes")
    p = some.add_parser("advanced")
    p.add_argument("query", nargs="?")
    p.add_argument("-k", type=int, default=10)
    p.add_argument("--json", action="store_true")
    p.add_argument("--config")
    p.add_argument("--save-config")
    p.add_argument("--months")
    for name, kind in (("years", int), ("institutions", str), ("exclude-institutions", str), ("doc-types", str), ("exclude-doc-types", str), ("entities", str), ("tags", str)):
        p.add_argument(f"--{name}", nargs="+", type=kind)
    for name in ("min-importance", "max-importance", "min-confidence"):
        p.add_argument(f"--{name}", type=float)
    p.add_argument("--exclude-boilerplate", action="store_true", default=None)
    return top


def advanced_filters(args: argparse.Namespace) -> AdvancedFilters:
    """The configuration's filters; arguments override only what they give."""
    own = AdvancedFilters.load(args.config).to_dict() if args.config else {}
    names = ("years", "institutions", "exclude_institutions", "doc_types", "exclude_doc_types", "entities", "tags", "min_importance", "max_importance", "min_confidence", "exclude_boilerplate")
    own |= {n: v for n in names if (v := getattr(args, n)) is not None}
    if args.months:
        own["months"] = month_numbers(args.months)
    return AdvancedFilters.from_dict(own)


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName("corvane").getOrCreate()
    store = Store(spark, args.store, args.prefix)
    profile, taxonomy = (FULL, DOMAIN) if args.profile == "full" else (BASIC, BASIC_DOMAIN)
    if args.taxonomy:
        taxonomy = from_json(args.taxonomy, taxonomy)
    elif args.do in ("enrich", "full", "search", "prompt"):
        print("without --taxonomy no variables are found", file=sys.stderr)
    load = _loader(args.model, args.dimension)
    documents, chunks = f"{args.work}/documents", f"{args.work}/chunks"
    if args.do in ("extract", "full"):
        found, pieces = files.extract(spark, args.data, profile)
        write_json(found, documents)
        write_json(pieces, chunks)
        held = read_documents_json(spark, documents)
        stats.extraction_report(held).show()
        stats.extraction_warnings(held).show(1000, truncate=False)
        stats.order_statistics(spark.read.schema(PIECES).json(chunks), "char_count").show()
    if args.do in ("enrich", "full"):
        rich = enrich.embed_text(enrich.enrich_chunks(spark.read.schema(PIECES).json(chunks), read_documents_json(spark, documents), taxonomy), args.model, taxonomy)
        write_json(embed.with_vectors(rich, load, args.model).drop("embed_text"), f"{args.work}/enriched")
    if args.do in ("load", "full"):
        store.setup()
        skipped = store.load(read_documents_json(spark, documents), read_chunks_json(spark, f"{args.work}/enriched"), args.dimension)
        print(f"chunks left out for their vector: {skipped}")
    if args.do == "index":
        print(f"buckets indexed: {Indexes(store, f'{args.store.rstrip("/")}/{args.prefix}indexes').refresh()}")
    if args.do == "setup":
        store.setup(drop=args.drop)
    if args.do == "stats":
        kept = Reports(store, f"{args.store.rstrip('/')}/{args.prefix}reports")
        kept.refresh()
        for table in (kept.by_type(), kept.by_section(), kept.importance_summary(), kept.key_histogram()):
            table.show(50, truncate=False)
    if args.do in ("search", "prompt"):
        embedder = lambda q: embed.query_vector(q, load, args.model)
        options = {"use_mmr": not args.no_mmr, "taxonomy": taxonomy, "profile": profile}
        if args.indexed:
            hits, parsed = search.search_store(store, Indexes(store, f"{args.store.rstrip('/')}/{args.prefix}indexes"), args.query, embedder, args.k, **options)
        else:
            hits, parsed = search.search(store.read("chunks"), store.read("documents"), args.query, embedder, args.k, **options)
        hits = prompt.numbered(hits, [F.desc("final_score"), F.col("chunk_id")]).cache()
        if args.do == "prompt":
            print(prompt.prompt(args.query, hits, args.system)[0])
        else:
            print(prompt.json_report(hits.orderBy("citation_number"), parsed) if args.json else prompt.text_report(hits, parsed, whole_sheets=profile.whole_sheets))
    if args.do == "advanced":
        own = advanced_filters(args)
        if args.save_config:
            own.save(args.save_config)
        hits = search.advanced_search(store.read("chunks"), store.read("documents"), own, args.query, args.k, embed=(lambda q: embed.query_vector(q, load, args.model)) if args.query else None)
        if args.json:
            print(prompt.json_report(hits, {"raw_query": args.query, "filters": own.to_dict()}))
        else:
            hits.select("chunk_id", "filename", "section_type", "importance_score").show(args.k, truncate=False)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
