"""Own sample inputs, written to temp files by the tests."""

# Delimited lines without a header, 5 fields, no newline at the end.
LINES = ("NOVA,2021-03-01,10.50,11.00,700\nNOVA,2021-03-02,11.50,12.25,650\n"
         "QUAY,2021-03-01,3.25,3.50,90\nNOVA,2021-03-03,12.50,12.75,800\n"
         "BYTE,2021-03-01,100.00,104.00,20\nQUAY,2021-03-02,3.75,4.00,95\n"
         "QUAY,2021-03-03,4.25,4.25,80\nQUAY,2021-03-04,4.75,5.00,60")

# Paragraphs with CRLF, blank and white-space lines, curly quotes, a pipe and repeats.
PARAGRAPHS = ("Green boats drift past green boats.\r\n \r\n\r\n"
              "The river’s mouth holds sand|silt, and sand|silt holds the river.\r\n"
              "Of the and it\r\n\t\r\n“Green boats” SING\r\n")
