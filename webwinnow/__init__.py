"""Web-page extraction and ranking as Spark plans."""

from webwinnow.plans.extract import extract, extract_requested, results
from webwinnow.plans.session import configure
from webwinnow.sources.pages import dom_nodes, read_pages, requested_pages, scan_dom

__version__ = "0.1.0"
__all__ = ["configure", "dom_nodes", "extract", "extract_requested", "read_pages", "requested_pages", "results", "scan_dom"]
