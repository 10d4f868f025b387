"""Entry script for ``spark-submit submit.py <job> ...``; see ``millrace/jobs.py``."""

from millrace.jobs import main

if __name__ == "__main__":
    main()
