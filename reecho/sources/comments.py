"""Comment and document tables as ``(doc_id, user_id, text)`` messages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from reecho.schemas import BIGINT, BOOLEAN, INT, STRING, TIMESTAMP, record

# The header of the comment export, in file order.
COMMENT_SCHEMA = record(
    commentID=STRING,
    status=STRING,
    commentSequence=BIGINT,
    userID=STRING,
    userDisplayName=STRING,
    userLocation=STRING,
    userTitle=STRING,
    commentBody=STRING,
    createDate=TIMESTAMP,
    updateDate=TIMESTAMP,
    approveDate=TIMESTAMP,
    recommendations=INT,
    replyCount=INT,
    editorsSelection=BOOLEAN,
    parentID=STRING,
    parentUserDisplayName=STRING,
    depth=INT,
    commentType=STRING,
    trusted=INT,
    recommendedFlag=INT,
    permID=STRING,
    isAnonymous=BOOLEAN,
    articleID=STRING,
)


def read_comments_csv(spark: SparkSession, path: str, schema: T.StructType = COMMENT_SCHEMA) -> DataFrame:
    """Comment CSV with header, quoted line breaks and doubled quotes.

    A multi-line CSV file is one task; large exports should come as many files.
    """
    return spark.read.schema(schema).csv(
        path, header=True, multiLine=True, quote='"', escape='"', timestampFormat="yyyy-MM-dd HH:mm:ss"
    )


def write_comments_csv(frame: DataFrame, path: str) -> None:
    frame.write.mode("overwrite").csv(
        path,
        header=True,
        quote='"',
        escape='"',
        emptyValue='""',
        ignoreLeadingWhiteSpace=False,
        ignoreTrailingWhiteSpace=False,
    )


def sample_head(frame: DataFrame, n: int, *order: str) -> DataFrame:
    """First ``n`` rows by ``order``; 0 keeps all."""
    return frame.orderBy(*order).limit(n) if n > 0 else frame


def to_message(comments: DataFrame, produced_at: Column | None = None) -> DataFrame:
    """``(id, text, user_id, produced_at)``; an id that is no number is an error.

    An empty field is an empty text, not a null. ``produced_at`` is in epoch seconds, by default the time of the query.
    """
    stamp = F.current_timestamp().cast("double") if produced_at is None else produced_at.cast("double")
    return comments.select(
        F.col("commentID").try_cast("bigint").alias("parsed"),
        "commentID",
        F.coalesce("commentBody", F.lit("")).alias("text"),
        F.coalesce(F.col("userID").cast("string"), F.lit("")).alias("user_id"),
        stamp.alias("produced_at"),
    ).select(
        F.when(F.col("parsed").isNotNull(), F.col("parsed"))
        .otherwise(F.raise_error(F.concat(F.lit("bad comment id: "), F.coalesce("commentID", F.lit("null")))))
        .cast("bigint")
        .alias("id"),
        "text",
        "user_id",
        "produced_at",
    )


def to_documents(messages: DataFrame) -> DataFrame:
    """Messages under the names that the matching job uses."""
    return messages.withColumnRenamed("id", "doc_id")


def read_documents(spark: SparkSession, path: str, author: str = "source") -> DataFrame:
    """Parquet documents, spread over the cluster if they are stored in fewer splits than it has cores."""
    docs = spark.read.parquet(path).select("doc_id", F.col(author).cast("string").alias("user_id"), "text")
    return spread(docs)


def spread(scan: DataFrame) -> DataFrame:
    """Redistribute a plain file scan with too few splits; larger scans stay as they are."""
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores * 2) if scan.rdd.getNumPartitions() < cores else scan
