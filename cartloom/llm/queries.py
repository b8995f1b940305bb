"""All queries of this subpackage and their oracle texts."""

from cartloom.llm import benchmarks, chat, html, language, lines, mixing, negatives, quality, repair, simhash, tokens, urls, vectors  # noqa: F401
from cartloom.llm.common import ORACLE, QUERIES  # noqa: F401
