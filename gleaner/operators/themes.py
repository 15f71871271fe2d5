"""Keyword themes.

Assignment is an ordered CASE (first theme with any keyword wins).  The
board keeps the first five items of each theme by rank with
``row_number() <= 5``, which Spark plans as a partial WindowGroupLimit
before the shuffle, so even a theme holding most items ships only five
rows per map task.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.common import let
from .gate import gate_text
from .patterns import INLINE, first_match, matches_any

# The reference's eight ordered themes and their keywords.
DEFAULT_THEMES: list[tuple[str, list[str]]] = [
    ("大模型与推理", ["llm", "gpt", "claude", "gemini", "reasoning", "chain-of-thought", "inference",
                "context window", "token", "deepseek"]),
    ("多模态与生成", ["multimodal", "vision", "image", "video", "diffusion", "text-to", "speech",
                "audio", "sora"]),
    ("Agent 与工具", ["agent", "tool use", "function call", "mcp", "autogen", "langchain", "workflow",
                  "orchestrat"]),
    ("基准与评测", ["benchmark", "leaderboard", "arena", "eval", "mmlu", "humaneval", "score", "sota",
               "mlperf"]),
    ("安全与对齐", ["safety", "alignment", "rlhf", "red team", "guardrail", "jailbreak", "responsible",
               "regulation", "nist", "aisi"]),
    ("基础设施与芯片", ["gpu", "tpu", "chip", "nvidia", "h100", "b200", "inference server",
                 "training cluster", "hardware"]),
    ("开源与社区", ["open source", "open weight", "hugging face", "github", "license", "community",
               "release"]),
    ("融资与商业", ["funding", "acquisition", "valuation", "series", "revenue", "partnership",
               "enterprise", "pricing"]),
]
REFS_PER_THEME = 5


def theme_of(title: Column | str, excerpt: Column | str,
             lexicon: list[tuple[str, list[str]]] = DEFAULT_THEMES) -> Column:
    words = [(w.lower(), name) for name, ws in lexicon for w in ws]
    if len(words) > INLINE:
        # the first keyword of the ordered lexicon names the theme
        names = F.array(*[F.lit(name) for name, _ in lexicon])
        owner = F.from_json(F.lit(json.dumps([[n for n, _ in lexicon].index(name) for _, name in words])), "array<int>")
        return F.get(names, F.get(owner, first_match(gate_text(title, excerpt), [w for w, _ in words])))

    def first(text: Column) -> Column:
        c = F.when(F.lit(False), F.lit(None).cast("string"))
        for name, words in lexicon:
            c = c.when(matches_any(text, words), F.lit(name))
        return c
    return let(gate_text(title, excerpt), first)


def assign(items: DataFrame, lexicon: list[tuple[str, list[str]]] = DEFAULT_THEMES) -> DataFrame:
    """Add ``theme`` (NULL when no keyword matches)."""
    return items.withColumn("theme", theme_of("title", "excerpt", lexicon))


def board(ranked: DataFrame, lexicon: list[tuple[str, list[str]]] = DEFAULT_THEMES,
          max_themes: int | None = None, refs: int = REFS_PER_THEME) -> DataFrame:
    """Themes by item count desc (ties: earliest first item), the first
    ``max_themes`` (all by default); each with its first ``refs`` items by
    rank.  Needs ``rank``."""
    t = assign(ranked, lexicon).where(F.col("theme").isNotNull())
    counts = t.groupBy("theme").agg(F.count(F.lit(1)).cast("long").alias("n"),
                                    F.min("rank").alias("first_rank"))
    w = Window.partitionBy("theme").orderBy("rank")
    top = (t.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= refs)
           .groupBy("theme")
           .agg(F.sort_array(F.collect_list(F.struct("rank", "title", "url", "publish_date"))).alias("refs")))
    out = counts.join(top, "theme")
    if max_themes is not None:
        out = out.orderBy(F.col("n").desc(), F.col("first_rank").asc()).limit(max_themes)
    return out
