from __future__ import annotations

import os
import sys

# This folder is a package, so that its test_queries and that of the folder above are told apart; its helpers are imported by name.
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
