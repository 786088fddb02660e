"""One module per section of the operator inventory."""

from importlib import import_module

MODULES = ("scoring", "linkage", "overlay", "reports", "selection", "texts", "filtering", "reading", "runs")

for _m in MODULES:
    import_module(f"{__name__}.{_m}")
