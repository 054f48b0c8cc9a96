from docshred.plans.clinical import TABLE_NAMES, clinical_specs, spec_by_name
from docshred.plans.spec import TableSpec, WideSpec

__all__ = ["TABLE_NAMES", "TableSpec", "WideSpec", "clinical_specs", "spec_by_name"]
