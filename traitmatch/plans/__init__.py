"""Physical-plan helpers: checked broadcasts, lineage cuts, the distributed
global rank, and the registered query keys."""

from traitmatch.plans.lineage import cut_lineage
from traitmatch.plans.ranking import global_rank
from traitmatch.plans.sizing import bounded

__all__ = ["bounded", "cut_lineage", "global_rank"]
