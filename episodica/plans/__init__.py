"""The queries of the reference's operators, by theme."""

from .catalogue import QUERIES, SQL  # noqa: F401
from . import joins, mixtures, quality, records, sequences, storage, streams, texts, vectors  # noqa: E402, F401
