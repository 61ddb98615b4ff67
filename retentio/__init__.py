"""retentio: churn analytics expressed as Spark DataFrame plans.

Every public operator takes and returns a DataFrame. Fitted state (medians,
modes, dictionaries, scaler moments) is a small, column-bounded result that
is computed by one distributed aggregate and replayed as literals.
"""

from retentio.session import get_session, checkpoint_dir  # noqa: F401

__all__ = ["get_session", "checkpoint_dir"]
