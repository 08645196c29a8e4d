"""End-to-end plans built from the operators."""

from .pipelines import (MercatorOptions, TriplineOptions, build_segments, legacy_mercator_options,
                        legacy_tripline_options, mercator_pipeline, tripline_pipeline)

__all__ = ["MercatorOptions", "TriplineOptions", "build_segments", "legacy_mercator_options",
           "legacy_tripline_options", "mercator_pipeline", "tripline_pipeline"]
