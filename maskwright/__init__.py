"""Find, mask, audit and restore personal data in Spark text columns."""

from maskwright.functions.catalogue import CATEGORIES, REQUESTABLE
from maskwright.operators.audit import (
    audit_log,
    dataset_audit,
    flag_split,
    leak_check,
    row_audit,
    summarise_entities,
)
from maskwright.operators.detect import detect, detect_counts, detect_samples, hits
from maskwright.operators.enrich import private_enrich
from maskwright.operators.mask import (
    mask,
    mask_entities,
    mask_with_vault,
    take_apart,
    vault_rows,
)
from maskwright.operators.restore import restore, restore_with_mapping

__version__ = "0.1.0"

__all__ = [
    "CATEGORIES",
    "REQUESTABLE",
    "audit_log",
    "dataset_audit",
    "detect",
    "detect_counts",
    "detect_samples",
    "flag_split",
    "hits",
    "leak_check",
    "mask",
    "mask_entities",
    "mask_with_vault",
    "private_enrich",
    "restore",
    "restore_with_mapping",
    "row_audit",
    "summarise_entities",
    "take_apart",
    "vault_rows",
]
