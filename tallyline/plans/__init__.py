"""Plan shapes shared by the operators: joins and windows that stay safe under skew."""

from tallyline.plans.joins import split_outer_join
from tallyline.plans.windows import in_pieces, with_previous, with_running_max

__all__ = ["in_pieces", "split_outer_join", "with_previous", "with_running_max"]
