"""The jobs for spark-submit: ``python -m evenkeel <job> ...``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from pathlib import Path

from pyspark.sql import SparkSession

from evenkeel.operators.balance import MODES, SEED
from evenkeel.operators.categories import BROADCAST_LABELS
from evenkeel.plans import jobs
from evenkeel.plans.classifier import ELASTIC_NET, ITERATIONS, REGULARISATION, THRESHOLD
from evenkeel.plans.features import FILLS, ON_INVALID, FittedFeatures
from evenkeel.presets import card_transactions
from evenkeel.spec import FeatureSpec


def arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="evenkeel", description=__doc__)
    commands = parser.add_subparsers(dest="job", required=True)

    def command(name: str, *paths: str) -> argparse.ArgumentParser:
        sub = commands.add_parser(name)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    propose = command("propose-types", "table", "report")
    propose.add_argument("--spec", help="JSON file; says which columns cannot be read as it declares them")
    propose.add_argument("--multi-line", action="store_true", help="cells have line breaks; a file is then one task")

    fit = command("train-features", "facts", "details", "features", "state")
    fit.add_argument("--spec", help="JSON file; card transactions if left out")
    fit.add_argument("--compat", action="store_true")
    fit.add_argument("--on-invalid", choices=ON_INVALID, default="error")
    fit.add_argument("--drop-empty", action="store_true")
    fit.add_argument("--median", choices=("exact", "approximate"), default="exact")
    fit.add_argument("--labels-on-driver", type=int, default=BROADCAST_LABELS, help="of all categories together")

    apply = command("score-features", "facts", "details", "state", "features")
    apply.add_argument("--fill", choices=FILLS, default="impute")
    for reads_csv in (fit, apply):
        reads_csv.add_argument("--salts", type=int, default=1, help="partitions per key in the join")
        reads_csv.add_argument("--hot-keys", action="store_true", help="find the keys that need spreading instead")
        reads_csv.add_argument("--malformed", choices=("FAILFAST", "PERMISSIVE"), default="FAILFAST")

    train = command("train-model", "features", "state", "model", "report", "curve")
    train.add_argument("--mode", choices=MODES, default="replicate")
    train.add_argument("--seed", type=int, default=SEED)
    train.add_argument("--shuffle", action="store_true")
    train.add_argument("--partitions", type=int)
    train.add_argument("--iterations", type=int, default=ITERATIONS)
    train.add_argument("--penalty", type=float, default=REGULARISATION)
    train.add_argument("--elastic-net", type=float, default=ELASTIC_NET)
    train.add_argument("--threshold", type=float, default=THRESHOLD)
    train.add_argument("--tree-depth", type=int, default=2, help="levels in which gradients are summed")
    train.add_argument("--allow-undersampling", action="store_true")
    train.add_argument("--hold-out", type=float, default=0.0, help="share of the keys kept from the fit")
    train.add_argument("--held-out", help="where the rows kept from the fit are written")

    train.add_argument("--fold", action="store_true", help="add up equal rows before the fit")

    judge = command("evaluate", "features", "state", "model", "report", "curve")
    for draws_curve in (train, judge):
        draws_curve.add_argument("--curve-points", type=int, help="at most; a point for every score if left out")
    command("curve-area", "curve", "out")

    score = command("score", "features", "state", "model", "out")
    score.add_argument("--files", type=int)
    return parser


def main(argv: Sequence[str] | None = None) -> None:
    args = arguments().parse_args(argv)
    spark = SparkSession.builder.appName(f"evenkeel {args.job}").getOrCreate()
    if args.job == "propose-types":
        spec = FeatureSpec.from_json(Path(args.spec).read_text()) if args.spec else None
        jobs.propose_types(spark, args.table, args.report, spec, args.multi_line)
        return
    if args.job == "train-features":
        spec = FeatureSpec.from_json(Path(args.spec).read_text()) if args.spec else card_transactions()
        jobs.build_training_features(
            spark, spec, args.facts, args.details, args.features, args.state,
            salts=args.salts, malformed=args.malformed, hot_keys=args.hot_keys,
            compat=args.compat, on_invalid=args.on_invalid, drop_empty=args.drop_empty,
            median=args.median, labels_on_driver=args.labels_on_driver,
        )
        return
    if args.job == "score-features":
        jobs.build_scoring_features(
            spark, args.facts, args.details, args.state, args.features, args.fill, args.salts, args.malformed,
            args.hot_keys,
        )
        return
    if args.job == "curve-area":
        jobs.curve_area(spark, args.curve, args.out)
        return
    spec = FittedFeatures.load_spec(spark, args.state)
    if args.job == "train-model":
        jobs.train(
            spark, args.features, spec.label, spec.key, args.model, args.report, args.curve,
            hold_out_share=args.hold_out, held_out=args.held_out,
            mode=args.mode, seed=args.seed, shuffle=args.shuffle, partitions=args.partitions,
            max_iter=args.iterations, reg_param=args.penalty, elastic_net=args.elastic_net, threshold=args.threshold,
            tree_depth=args.tree_depth, allow_undersampling=args.allow_undersampling, fold=args.fold,
            curve_points=args.curve_points,
        )
    elif args.job == "evaluate":
        jobs.evaluate_table(spark, args.features, args.model, spec.label, args.report, args.curve, args.curve_points)
    else:
        jobs.score_to_csv(spark, args.features, args.model, spec.key, spec.label, args.out, args.files)


if __name__ == "__main__":
    main()
