from cohortscope.functions.labels import blank_to, checked_labels, recode, relabel
from cohortscope.functions.shares import COUNT_TYPE, SHARE_TYPE, gap, ratio, share

__all__ = ["COUNT_TYPE", "SHARE_TYPE", "blank_to", "checked_labels", "gap", "ratio", "recode", "relabel", "share"]
