"""Helpers shared by the registered checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# White space as the engine understands it, spelt out for the checking SQL.
SQL_SPACE = (r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
             r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")

STOP_WORDS = ("the", "and", "of", "in", "to", "is", "la", "de", "et")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def table_stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The table as a stream, whether it is one file or a folder of files."""
    # A pattern, as a stream takes a plain path for a folder.
    return spark.readStream.schema(table(spark, sf_dir, name).schema).parquet(f"{sf_dir}/{name}[.]parquet")


def sql_strip(c: str) -> str:
    return f"regexp_replace(regexp_replace({c}, '^{SQL_SPACE}+', ''), '{SQL_SPACE}+$', '')"


def sql_collapse(c: str) -> str:
    return f"trim(regexp_replace({c}, '{SQL_SPACE}+', ' ', 'g'), ' ')"


def sql_words(c: str) -> str:
    """Lower-cased words without the stop words, as a list."""
    stop = ", ".join(f"'{w}'" for w in STOP_WORDS)
    return (f"list_filter(regexp_extract_all(lower({c}), '[\\p{{L}}\\p{{N}}_]{{2,}}'), "
            f"lambda w: w NOT IN ({stop}))")


def sql_terms(words: str) -> str:
    return f"{words} || list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1])"


def sql_vocabulary(min_df: int, max_terms: int) -> str:
    """CTEs w (words), p (term counts) and v (vocabulary) of the documents."""
    return f"""
w AS (SELECT doc_id, {sql_words('text')} AS w FROM documents),
p AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({sql_terms('w')}) AS term FROM w) GROUP BY 1, 2),
v AS (SELECT term, row_number() OVER (ORDER BY term) - 1 AS index, df, cf,
    ln((1 + (SELECT count(*) FROM documents)) / (1 + df)) + 1 AS idf
  FROM (SELECT term, count(*) AS df, sum(tf)::BIGINT AS cf FROM p GROUP BY 1
    HAVING count(*) >= {min_df} ORDER BY cf DESC, term LIMIT {max_terms}))"""
