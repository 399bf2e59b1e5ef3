"""Small frames for the corpus operators; the session comes from the parent folder."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))
