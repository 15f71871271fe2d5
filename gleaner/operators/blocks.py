"""Document -> publishable blocks (G9) and media/file helpers.

Paragraphs are split at blank lines; a paragraph starting with ``^`` is a
heading; others are cut into fixed-size chunks with ``sequence`` +
``explode``.  Numbering is per document (a window bounded by one text),
and every block is kept: the publish cap is a flag, not a filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import col, strip

MAX_LEN = 2000        # fixed: characters per paragraph block
MAX_BLOCKS = 100      # fixed: blocks sent with one page
# Image suffixes collected from a folder.
IMAGE_SUFFIXES = [".png", ".jpg", ".jpeg", ".webp", ".gif"]


def doc_title(text: Column | str, default: str = "Untitled") -> Column:
    """First line of the stripped text, or a default."""
    first = strip(F.substring_index(strip(col(text)), "\n", 1))
    return F.when(first == "", F.lit(default)).otherwise(first)


def text_to_blocks(docs: DataFrame, id_col: str, text_col: str, max_len: int = MAX_LEN,
                   max_blocks: int = MAX_BLOCKS) -> DataFrame:
    """(id, text) -> (id, block_ord, block_type, content, sent)."""
    paras = docs.select(id_col, F.posexplode(F.split(strip(F.col(text_col)), "\n{2,}")).alias("p_pos", "p"))
    paras = paras.select(id_col, "p_pos", strip("p").alias("p")).where(F.col("p") != "")
    heading = F.startswith(F.col("p"), F.lit("^"))
    n_chunks = F.when(heading, F.lit(1)).otherwise(F.ceil(F.length("p") / max_len).cast("int"))
    chunks = paras.select(id_col, "p_pos", "p", heading.alias("heading"),
                          F.explode(F.sequence(F.lit(0), n_chunks - 1)).alias("c"))
    content = F.when(F.col("heading"), F.regexp_replace("p", "^[\\^ ]+", "")).otherwise(
        F.substring("p", F.col("c") * max_len + 1, max_len))
    w = Window.partitionBy(id_col).orderBy("p_pos", "c")
    return (chunks.select(id_col, "p_pos", "c",
                          F.when(F.col("heading"), F.lit("heading_3")).otherwise(F.lit("paragraph")).alias("block_type"),
                          content.alias("content"))
            .withColumn("block_ord", F.row_number().over(w).cast("long"))
            .withColumn("sent", F.col("block_ord") <= max_blocks)
            .drop("p_pos", "c"))


def media_type(path: Column | str) -> Column:
    """image / pdf / audio / video / file from the file suffix."""
    p = F.lower(col(path))
    ext = F.regexp_extract(p, "\\.([a-z0-9]+)$", 1)
    return (F.when(ext.isin("png", "jpg", "jpeg", "gif", "webp", "bmp", "svg", "tif", "tiff", "ico"), F.lit("image"))
            .when(ext == "pdf", F.lit("pdf"))
            .when(ext.isin("mp3", "wav", "ogg", "m4a", "aac", "flac", "aif", "aiff"), F.lit("audio"))
            .when(ext.isin("mp4", "mov", "avi", "webm", "mkv", "mpeg", "mpg", "m4v"), F.lit("video"))
            .otherwise(F.lit("file")))


def slide_caption(name: Column | str) -> Column:
    """``Slide n`` from the first digit run of a file name, else the name."""
    d = F.regexp_extract(col(name), "([0-9]+)", 1)
    return F.when(d != "", F.concat(F.lit("Slide "), F.regexp_replace(d, "^0+([0-9])", "$1"))).otherwise(col(name))


def image_files(files: DataFrame, name_col: str) -> DataFrame:
    """Rows whose file name has an image suffix (any case)."""
    return files.where(F.lower(F.col(name_col)).rlike("(" + "|".join(s.replace(".", "[.]") for s in IMAGE_SUFFIXES) + ")$"))
