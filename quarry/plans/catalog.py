"""Imports every catalogue module so that all keys are registered."""

from . import docs_catalog  # noqa: F401
from . import pages_catalog  # noqa: F401
from . import vectors_catalog  # noqa: F401
from . import jobs_catalog  # noqa: F401
from . import parse_catalog  # noqa: F401
from . import stream_catalog  # noqa: F401
from . import files_catalog  # noqa: F401
from . import delta_catalog  # noqa: F401
