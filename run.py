"""Command line of the batch jobs: ``spark-submit run.py JOB --option value ...``."""

from townvoice.jobs import main

if __name__ == "__main__":
    main()
