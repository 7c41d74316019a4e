"""A PySpark-native engine for document analytics, retrieval and corpus preparation."""

#: Names of the package, loaded when they are asked for: workers import this file and need none of them.
EXPORTS = {
    "RetrievalEngine": "docloom.plans.corpus",
    "Settings": "docloom.settings",
    "VectorStore": "docloom.operators.store",
    "analyze": "docloom.plans.corpus",
    "build_corpus": "docloom.plans.corpus",
    "load_folder": "docloom.plans.corpus",
    "run_pipeline": "docloom.plans.corpus",
}
__all__ = list(EXPORTS)


def __getattr__(name: str):
    if name not in EXPORTS:
        raise AttributeError(f"module {__name__} has no attribute {name}")
    import importlib

    return getattr(importlib.import_module(EXPORTS[name]), name)
