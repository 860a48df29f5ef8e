"""Libraries of files: listings, routing tables and what is still to be done. Files are never moved by executors."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silkmill.functions.text import about_animals, base_name, file_bucket


def file_listing(spark: SparkSession, folder: str, glob: str | None = None) -> DataFrame:
    """(filename, dirs, filepath) of all files under a folder, dirs relative to it; contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    listed = reader.load(folder).select(F.col("path").alias("filepath"))
    name = base_name(F.col("filepath"))
    root = folder.rstrip("/").removeprefix("file://") + "/"
    inside = F.substring_index("filepath", root, -1)
    dirs = F.regexp_replace(inside, "/?[^/]*$", "")
    return listed.select(name.alias("filename"), dirs.alias("dirs"), "filepath")


def routing_table(files: DataFrame, path: str, compat: bool = False) -> DataFrame:
    """Adds filename, bucket by ending, and action: delete (books about animals), stay or move."""
    name = base_name(F.col(path))
    bucket = file_bucket(F.col(path), compat)
    action = F.when(about_animals(name), "delete").when(bucket == "stay", "stay").otherwise("move")
    return files.withColumn("filename", name).withColumn("bucket", bucket).withColumn("action", action)


def not_done(todo: DataFrame, key: str, done: DataFrame, done_key: str) -> DataFrame:
    """Rows of ``todo`` whose key no row of ``done`` has; rows without a key are to do."""
    return todo.join(done.select(F.col(done_key).alias(key)).distinct(), key, "left_anti")


def unprocessed_books(books: DataFrame, path: str, images: DataFrame, image_path: str) -> DataFrame:
    """Books that no image names: an image is called after its book, without the ending, before a double underscore."""
    named = images.select(F.substring_index(base_name(F.col(image_path)), "__", 1).alias("_k")).distinct()
    return books.withColumn("_k", F.regexp_replace(base_name(F.col(path)), r"\.pdf$", "")).join(named, "_k", "left_anti").drop("_k")


def unclassified(files: DataFrame, path: str, placed: DataFrame, placed_path: str) -> DataFrame:
    """Files whose name no placed file has, in whatever folder it lies."""
    known = placed.select(base_name(F.col(placed_path)).alias("_k")).distinct()
    return files.withColumn("_k", base_name(F.col(path))).join(known, "_k", "left_anti").drop("_k")
