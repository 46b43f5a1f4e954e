from eventide.plans.spec import PaneSpec, Trigger, TickWatermark, StepWatermark
from eventide.plans.scan import running_sums, with_prev, with_next

__all__ = ["PaneSpec", "Trigger", "TickWatermark", "StepWatermark", "running_sums", "with_prev", "with_next"]
