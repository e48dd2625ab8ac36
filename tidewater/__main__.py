from tidewater.cli import main

main()
