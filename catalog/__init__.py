"""The library's operators as named queries over the given tables, with SQL to check them."""

from catalog.registry import ORACLE, QUERIES  # noqa: F401
from catalog import corpus, learning, raters, relational, texts  # noqa: F401,E402  (they fill the registry)
