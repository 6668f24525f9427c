"""``python -m spendlink threshold mode project FULL|PARTIAL FUZZY|FAST_FUZZY [only_top] --data DIR --output DIR``"""

import argparse

from pyspark.sql import SparkSession

from spendlink.plans.run import Job, Tables, run


def main() -> None:
    parser = argparse.ArgumentParser(prog="spendlink")
    parser.add_argument("job", nargs="+", help="threshold mode project FULL|PARTIAL FUZZY|FAST_FUZZY [only_top]")
    parser.add_argument("--data", required=True, help="folder of items, sheets and reference tables")
    parser.add_argument("--output", required=True, help="folder of checkpoints and results")
    parser.add_argument("--format", default="parquet", choices=("parquet", "csv"))
    parser.add_argument("--exact-case", action="store_true", help="compare manufacturers as they are written")
    parser.add_argument("--both-forms", action="store_true", help="FAST_FUZZY normalises the catalogue's text too")
    parser.add_argument("--keep-unclassified", action="store_true", help="keep items the classifier does not answer for")
    args = parser.parse_args()
    try:
        job = Job.parse(args.job, exact_case=args.exact_case, both_forms=args.both_forms, keep_unclassified=args.keep_unclassified)
    except ValueError as error:
        parser.error(str(error))
    spark = SparkSession.builder.appName("spendlink").getOrCreate()
    print(run(spark, job, Tables(spark, args.data), args.output, args.format))


if __name__ == "__main__":
    main()
