"""Command line: ``python -m tallymill.cli {reports,sample,recommend} ...``"""

from __future__ import annotations

import argparse

from tallymill.plans import recommender, reports, runs, sampler, tuning
from tallymill.session import build_session
from tallymill.sources import readers


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="tallymill")
    root.add_argument("--master", help="only for local runs; otherwise left to spark-submit")
    root.add_argument("--shuffle-partitions", type=int)
    root.add_argument("--checkpoint-dir", help="shared folder, unless spark.checkpoint.dir is set")
    commands = root.add_subparsers(dest="command", required=True)

    flights = commands.add_parser("reports", help="six top-10 flight reports")
    flights.add_argument("flights")
    flights.add_argument("out", help="every run writes below a fresh folder of its own in here")
    flights.add_argument("--separate", action="store_true", help="one query per report over cached flights")

    sample = commands.add_parser("sample", help="stratified sample of a ratings file")
    sample.add_argument("ratings")
    sample.add_argument("out")
    sample.add_argument("--ratio", type=float, default=sampler.RATIO)
    sample.add_argument("--seed", type=int, default=sampler.SEED)

    movies = commands.add_parser("recommend", help="tuned recommendations")
    movies.add_argument("mode", help="ALS or ALSCv")
    movies.add_argument("ratings")
    movies.add_argument("movies")
    movies.add_argument("out")
    movies.add_argument("--user", type=int, help="show the unrated movies of this user")
    movies.add_argument("--user-list", help="write that user's 100 best unrated movies to this path")
    movies.add_argument("--top", type=int, default=recommender.TOP_K)
    movies.add_argument("--max-iter", type=int, default=recommender.MAX_ITER)
    movies.add_argument("--blocks", type=int, default=recommender.BLOCKS, help="parallelism of a fit; another number gives another model")
    movies.add_argument("--ranks", type=int, nargs="+", default=list(tuning.RANKS))
    movies.add_argument("--reg-params", type=float, nargs="+", default=list(tuning.REG_PARAMS))
    movies.add_argument("--folds", type=int, default=tuning.FOLDS)
    movies.add_argument("--csv-mode", default="PERMISSIVE", help="PERMISSIVE, DROPMALFORMED or FAILFAST")
    movies.add_argument("--parallelism", type=int, help="fits that run side by side")
    movies.add_argument("--audit", action="store_true", help="check the published tables and write the faults")
    return root


def main(argv: list[str] | None = None) -> None:
    commands = parser()
    args = commands.parse_args(argv)
    if args.command == "recommend" and args.user_list and args.user is None:
        commands.error("--user-list needs --user")
    spark = build_session(
        f"tallymill-{args.command}", args.master, args.shuffle_partitions, args.checkpoint_dir
    )
    if args.command == "reports":
        for name, path in reports.run_reports(spark, args.flights, args.out, not args.separate).items():
            print(f"{name}: {path}")
    elif args.command == "sample":
        sampler.sample_ratings(spark, args.ratings, args.out, args.ratio, args.seed)
    else:
        run = runs.run_recommender(
            spark,
            args.mode,
            args.ratings,
            args.movies,
            args.out,
            user_id=args.user,
            k=args.top,
            max_iter=args.max_iter,
            blocks=args.blocks,
            ranks=tuple(args.ranks),
            reg_params=tuple(args.reg_params),
            folds=args.folds,
            parallelism=args.parallelism,
            csv_mode=args.csv_mode,
            audited=args.audit,
        )
        print(f"best parameters: {tuning.describe(run.best)}")
        run.metrics.show(100, truncate=False)
        if run.audit is not None:
            run.audit.show(truncate=False)
        if args.user is not None:
            print(f"unrated movies of user {args.user}, scored by the model")
            run.predicted.show(20, truncate=False)
            print(f"unrated movies of user {args.user}, from the shared recommendations")
            run.recommended.show(20, truncate=False)
            if args.user_list:
                ratings, movies = readers.read_ratings(spark, args.ratings, args.csv_mode), readers.read_movies(spark, args.movies)
                runs.write_user_list(run, args.user, ratings, movies, args.user_list)


if __name__ == "__main__":
    main()
