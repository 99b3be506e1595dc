"""Every operator bound to the driver's tables, each next to the SQL that says the same."""

import importlib
import pkgutil

for _module in sorted(m.name for m in pkgutil.iter_modules(__path__) if m.name != "common"):
    importlib.import_module(f"{__name__}.{_module}")
