"""All queries of this package."""

from ticktalk.llm import alignment, byte_bpe, exact_dedup, language, line_dedup, mixing, ngram_join, packing, quality, substring_dedup, suffix_dedup, urls, whitening  # noqa: F401
from ticktalk.llm.common import LLM_ORACLES, LLM_QUERIES

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]
