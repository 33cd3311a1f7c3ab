import os
import sys

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, ROOT)

SF = os.environ.get("SPINDLE_TEST_SF", "/root/testdata/sf0.001")
