"""Data-quality expectations. Each returns the failing rows; an empty frame is a pass.

``row_condition`` filters first. ``group_by`` turns a table-level check into one result per
group. Expressions are columns or SQL text. Unless a check says otherwise a missing value
passes, as a comparison with NULL is neither true nor false.
"""

from larder.operators.expectations.columns import *  # noqa: F401,F403
from larder.operators.expectations.core import *  # noqa: F401,F403
from larder.operators.expectations.distribution import *  # noqa: F401,F403
from larder.operators.expectations.records import *  # noqa: F401,F403
from larder.operators.expectations.sets import *  # noqa: F401,F403
from larder.operators.expectations.table import *  # noqa: F401,F403
