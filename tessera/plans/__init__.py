"""Dataset plans, the daily and training runs, and the queries over the given tables."""


def load_queries():
    import importlib
    import pkgutil

    from tessera.plans import registry

    for m in sorted(m.name for m in pkgutil.iter_modules(__path__) if m.name.startswith("q_")):
        importlib.import_module(f"{__name__}.{m}")
    return registry.QUERIES, registry.ORACLES
