"""python -m seqloom.cli STEP --in FOLDER --out FOLDER [--config FILE] [--codebooks FOLDER] [--model NAME]"""

from __future__ import annotations

import argparse
from datetime import UTC, datetime

from pyspark.sql import functions as F

from seqloom import config
from seqloom.operators.codebooks import train_codebooks
from seqloom.operators.tasks import current_semantic_ids
from seqloom.operators.validation import require_vectors
from seqloom.plans.artefacts import TokeniseSettings, tokenise_run, training_run, write_json
from seqloom.plans.catalogue import prepare_catalogue
from seqloom.plans.embed import HashingBackend, embed_texts
from seqloom.plans.ingest import bootstrap
from seqloom.plans.runs import path_exists
from seqloom.plans.training_set import PrepSettings
from seqloom.session import local_session, table
from seqloom.sources.readers import embeddings_with_names
from seqloom.sources.writers import export_tables, read_codebooks, write_codebooks


def main(argv: list[str] | None = None) -> int:
    """Import a CSV folder, prepare a catalogue, embed it, train codebooks, tokenise, or build a training set."""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("step", choices=["bootstrap", "prepare", "embed", "codebooks", "tokenise", "training-set"])
    parser.add_argument("--in", dest="source", required=True)
    parser.add_argument("--out", required=True)
    parser.add_argument("--config")
    parser.add_argument("--codebooks")
    parser.add_argument("--model", default="hashed-words")
    parser.add_argument("--dim", type=int, default=128)
    parser.add_argument("--levels", type=int, default=8)
    parser.add_argument("--codes", type=int, default=2048)
    parser.add_argument("--rebuild", action="store_true")
    parser.add_argument("--cores", default="*")
    args = parser.parse_args(argv)
    spark = local_session(args.cores, **({"spark.sql.shuffle.partitions": "200"} if args.cores == "*" else {}))
    now = datetime.now(UTC).isoformat(timespec="seconds")
    if args.step == "bootstrap":
        export_tables(bootstrap(spark, args.source, now), args.out)
    elif args.step == "prepare":
        prepare_catalogue(table(spark, args.source, "anime"), now).write.mode("overwrite").parquet(f"{args.out}/anime_prep.parquet")
    elif args.step == "embed":
        rows = embed_texts(table(spark, args.source, "anime_prep"), "anime_id", "anime_text", HashingBackend(args.dim), args.model, now)
        rows.write.mode("overwrite").parquet(f"{args.out}/anime_embeddings.parquet")
    elif args.step == "codebooks":
        vectors = table(spark, args.source, "anime_embeddings").where(F.col("model_name") == args.model)
        books, errors = train_codebooks(require_vectors(vectors, "anime_id", "embedding"), "embedding", args.levels, args.codes, order="anime_id")
        write_codebooks(spark, books, f"{args.out}/codebooks.parquet")
        write_json(spark, {"trained_at": now, "model_name": args.model, "levels": args.levels, "codebook_size": args.codes, "errors": errors}, f"{args.out}/codebooks.json")
    elif args.step == "tokenise":
        vectors = require_vectors(table(spark, args.source, "anime_embeddings").where(F.col("model_name") == args.model), "anime_id", "embedding")
        items = embeddings_with_names(vectors.select("anime_id", "embedding"), table(spark, args.source, "anime_prep"))
        log = f"{args.source}/user_anime.parquet"
        tokenise_run(items, read_codebooks(spark, args.codebooks), args.out, now, spark.read.parquet(log) if path_exists(spark, log) else None, TokeniseSettings(rebuild=args.rebuild), args.codebooks)
    else:
        settings = config.prep_settings(args.config) if args.config else PrepSettings()
        semantic = current_semantic_ids(table(spark, args.source, "anime_semantic_ids"))
        training_run(table(spark, args.source, "user_anime"), semantic, table(spark, args.source, "anime_prep"), args.out, now, settings)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
