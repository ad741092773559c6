"""End-to-end jobs and the registered queries."""

_MODULES = ["q_turns", "q_sentiment", "q_features", "q_portfolio", "q_metrics", "q_phrases", "q_models", "q_io", "q_scale"]


def load_all() -> None:
    """Import every query module so its ``@query`` registrations run."""
    import importlib
    for m in _MODULES:
        importlib.import_module(f"{__name__}.{m}")
