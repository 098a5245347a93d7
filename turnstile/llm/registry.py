"""All queries of the subpackage, by importing the modules that register them."""

from turnstile.llm import chat, collocations, licences, runs, substrings, near_copies, neighbours, packing, pseudonyms, quality, shuffle, tiling, token_files  # noqa: F401
from turnstile.llm.common import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
