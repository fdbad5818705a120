"""Files of a shared folder from Python tasks (see ``featlab.sources.shared_files``)."""

from featlab.sources.shared_files import get_array, open_folder, put  # noqa: F401
