"""The feature table as a persistable Spark ML stage.

Saved as the first stage of a fitted pipeline, the window settings travel
with the model; at scoring time only the cutoff needs overriding.
"""

from __future__ import annotations

from pyspark import keyword_only
from pyspark.ml import Transformer
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable

from userflow.operators.features import feature_table
from userflow.operators.windows import CutoffPlan
from userflow.sources.schema import LOG_PAGES, PAGE_CODES


class WindowedFeatures(Transformer, DefaultParamsReadable, DefaultParamsWritable):
    """Event log -> one feature / label row per (user, cutoff offset)."""

    cutoffMs = Param(Params._dummy(), "cutoffMs", "first cutoff, epoch ms", TypeConverters.toInt)
    lookBackDays = Param(Params._dummy(), "lookBackDays", "feature window in days", TypeConverters.toInt)
    lookAheadDays = Param(Params._dummy(), "lookAheadDays", "label window in days", TypeConverters.toInt)
    extraOffsets = Param(Params._dummy(), "extraOffsets", "number of earlier cutoffs", TypeConverters.toInt)
    intervalDays = Param(Params._dummy(), "intervalDays", "days between cutoffs", TypeConverters.toInt)
    ties = Param(Params._dummy(), "ties", "'one' or 'all' rows at a tied last ts", TypeConverters.toString)
    excludePriorChurn = Param(Params._dummy(), "excludePriorChurn", "drop users churned before the cutoff",
                              TypeConverters.toBoolean)
    pageNames = Param(Params._dummy(), "pageNames", "page name per code, in code order",
                      TypeConverters.toListString)

    @keyword_only
    def __init__(self, cutoffMs=None, lookBackDays=21, lookAheadDays=2, extraOffsets=0, intervalDays=1,
                 ties="one", pageNames=None, excludePriorChurn=False):
        super().__init__()
        self._setDefault(lookBackDays=21, lookAheadDays=2, extraOffsets=0, intervalDays=1, ties="one",
                         excludePriorChurn=False,
                         pageNames=[LOG_PAGES[c] for c, _ in PAGE_CODES])
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    @keyword_only
    def setParams(self, cutoffMs=None, lookBackDays=21, lookAheadDays=2, extraOffsets=0, intervalDays=1,
                  ties="one", pageNames=None, excludePriorChurn=False):
        return self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def setCutoffMs(self, value: int) -> "WindowedFeatures":
        return self._set(cutoffMs=value)

    def plan(self) -> CutoffPlan:
        return CutoffPlan(
            self.getOrDefault(self.cutoffMs),
            self.getOrDefault(self.lookBackDays),
            self.getOrDefault(self.lookAheadDays),
            self.getOrDefault(self.extraOffsets),
            self.getOrDefault(self.intervalDays),
        )

    def pages(self) -> dict[str, str]:
        names = self.getOrDefault(self.pageNames)
        return {code: name for (code, _), name in zip(PAGE_CODES, names, strict=True)}

    def _transform(self, dataset):
        return feature_table(dataset, self.plan(), self.pages(), self.getOrDefault(self.ties),
                             self.getOrDefault(self.excludePriorChurn))
