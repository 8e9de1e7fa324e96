"""Fit both models on labelled Parquet sets and save them."""

from __future__ import annotations

import argparse

from threatsieve.operators import token_bayes
from threatsieve.operators.training import fit_bayes, fit_gbdt, save_model
from threatsieve.session import build_session
from threatsieve.sources.lines import labelled_union, read_labelled


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("--master")
    parser.add_argument("--white", required=True, help="Parquet with a url column, label 1")
    parser.add_argument("--black", required=True, help="Parquet with a url column, label 0")
    parser.add_argument("--gbdt-model", required=True)
    parser.add_argument("--bayes-model", required=True)
    parser.add_argument(
        "--bayes-form", choices=("tables", "pipeline"), default="tables",
        help="tables hold any vocabulary; a pipeline is fitted on a bounded number of URLs",
    )
    args = parser.parse_args()
    spark = build_session("fit_models", args.master)
    labelled = labelled_union(
        read_labelled(spark, args.white, 1), read_labelled(spark, args.black, 0)
    )
    save_model(fit_gbdt(labelled), args.gbdt_model)
    if args.bayes_form == "tables":
        token_bayes.fit(labelled, args.bayes_model)
    else:
        save_model(fit_bayes(labelled), args.bayes_model)
    spark.stop()


if __name__ == "__main__":
    main()
