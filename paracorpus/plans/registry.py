"""All registered queries: importing the query modules fills the registry."""

from paracorpus.plans import q_core, q_encode, q_io, q_metrics, q_more, q_pipelines, q_rest, q_sample  # noqa: F401
from paracorpus.plans.base import ORACLES, QUERIES  # noqa: F401
