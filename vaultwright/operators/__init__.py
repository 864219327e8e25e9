from vaultwright.operators.hublink import KeyedLoad, attach_keys, load_hub, load_keyed, load_link
from vaultwright.operators.satellite import SatLoad, idempotent_view, load_satellite, validity_view

__all__ = [
    "KeyedLoad",
    "SatLoad",
    "attach_keys",
    "idempotent_view",
    "load_hub",
    "load_keyed",
    "load_link",
    "load_satellite",
    "validity_view",
]
