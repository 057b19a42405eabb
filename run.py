"""Entry script for spark-submit; see `cohortscope/__main__.py`."""

from cohortscope.__main__ import main

if __name__ == "__main__":
    main()
