"""Readers for messy inputs. Each returns a lazy DataFrame of text columns."""

from quarry.sources.html_table import extract_html_table  # noqa: F401
from quarry.sources.paged_json import assert_complete_pages, flatten_paged_json, read_paged_json  # noqa: F401
from quarry.sources.ragged_csv import parse_ragged_lines, read_ragged_csv  # noqa: F401
from quarry.sources.tabular import melt_wide, read_seed, require_columns, union_all  # noqa: F401
