"""Fixture mappings and the registered query catalog."""


def load_catalog():
    """Import every query module so that their ``@register`` calls run."""
    from ndflow.plans import q_bundle, q_flow, q_more, q_ops, q_scan  # noqa: F401
    from ndflow.plans.registry import ORACLES, QUERIES
    return QUERIES, ORACLES
