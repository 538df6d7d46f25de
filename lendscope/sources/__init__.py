"""Sources and sinks: loan CSV reader/writers, the text scrub job, the test view."""
