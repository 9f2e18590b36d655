"""Reading and writing the post tables."""

def read_csv(spark, path, schema, sep=","):
    """CSV with a header row; quoted text may hold separators, quotes and line breaks.

    The schema is explicit, so no extra pass over the file infers types. A file
    with line breaks inside quotes cannot be split: keep such input as many
    files, or store it as parquet after the first read.
    """
    return spark.read.schema(schema).csv(
        path, header=True, sep=sep, multiLine=True, quote='"', escape='"', enforceSchema=False
    )


def write_csv(df, path, sep=",", mode="errorifexists"):
    """CSV with a header row, one file per partition, quotes doubled inside quoted text."""
    df.write.mode(mode).csv(path, header=True, sep=sep, quote='"', escape='"', emptyValue="", lineSep="\n")


def read_table(spark, root, name):
    return spark.read.parquet(f"{root.rstrip('/')}/{name}.parquet")
