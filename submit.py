"""spark-submit entry point: ``spark-submit --py-files cohortlens.zip submit.py <step> ...``."""

from cohortlens.__main__ import main

if __name__ == "__main__":
    raise SystemExit(main())
