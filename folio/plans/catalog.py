"""All registered queries (importing the modules registers them)."""

from folio.plans import corpus_queries, files_queries, layout_corpus_queries, layout_queries, raster_queries, stream_queries  # noqa: F401
from folio.plans.registry import REGISTRY  # noqa: F401
