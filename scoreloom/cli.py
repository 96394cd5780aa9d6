"""Commands: preprocess, transform, tune, train, evaluate."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import SparkSession

from .operators import contextual, models
from .plans import catalog, runs
from .sources import files


def main(argv: list[str] | None = None, spark: SparkSession | None = None, expected_rows: dict[str, int] | None = None) -> object:
    parser = argparse.ArgumentParser(prog="scoreloom")
    commands = parser.add_subparsers(dest="command", required=True)
    p = commands.add_parser("preprocess")
    p.add_argument("--data-dir", required=True)
    p.add_argument("--representation", default="all")
    p.add_argument("--word2vec-architecture", default="cbow", choices=("cbow", "skipgram"))
    t = commands.add_parser("transform")
    t.add_argument("--csv", required=True)
    t.add_argument("--run", default="latest")
    t.add_argument("--representation", required=True)
    t.add_argument("--output", required=True)
    for p in (p, t):
        p.add_argument("--encoder", help="a folder with tokenizer.json and model.onnx")
        p.add_argument("--device", default="auto", choices=("auto", *contextual.PLACES))
        p.add_argument("--batch-size", type=int, default=4)
    for name in ("tune", "train", "evaluate"):
        p = commands.add_parser(name)
        p.add_argument("--config")
        p.add_argument("--run", default="latest")
        p.add_argument("--model", default="ridge", choices=sorted(models.CONFIG))
        p.add_argument("--representation", action="append")
        p.add_argument("--output", required=True)
    for p in commands.choices.values():
        p.add_argument("--runs", required=True)
    args = parser.parse_args(argv)
    spark = spark or SparkSession.builder.appName("scoreloom").getOrCreate()
    if args.command in ("preprocess", "transform"):
        encoder = contextual.Encoder(args.encoder, args.device, args.batch_size) if args.encoder else None
    if args.command == "preprocess":
        return runs.preprocess(spark, args.data_dir, args.runs, args.representation, args.word2vec_architecture, expected_rows, encoder=encoder)
    if args.command == "transform":
        name = catalog.canonical(args.representation)
        run = runs.resolve_or_raise(spark, args.runs, name, args.run)
        runs.transform(spark, run, name, files.load_rows(spark, args.csv), encoder).write.parquet(args.output)
        return args.output
    config = models.load_config(args.config)
    names = args.representation or config["representations"]
    params, _ = models.parameters(args.model, config["models"])
    out = {}
    for name in names:
        if args.command == "tune":
            try:
                run = runs.resolve_or_raise(spark, args.runs, name, args.run)
                out[name] = {"status": "ran", args.model: models.tune(runs.load(spark, run, name), args.model, config["models"])}
            except (FileNotFoundError, ValueError, OSError) as e:
                out[name] = {"status": "skipped", "reason": str(e)}
            continue
        run = runs.resolve_or_raise(spark, args.runs, name, args.run)
        df = runs.load(spark, run, name)
        if args.command == "train":
            out[name] = models.train_bundle(spark, run, name, df, args.model, params, args.output)
        else:
            out[name] = models.evaluate_bundle(spark, run, name, df, args.model, f"{args.output}/{name}/{args.model}")
            runs.write_text(spark, f"{args.output}/evaluation/{name}/{args.model}.json", json.dumps(out[name], indent=1))
    if args.command == "tune":
        runs.write_text(spark, f"{args.output}/tuning.json", json.dumps(out, indent=1, default=str))
    return out


if __name__ == "__main__":
    main()
